from tillscope.sinks.checkpoints import cut_lineage, new_folder
from tillscope.sinks.publishing import publish, read_published, superseded
from tillscope.sinks.tables import (
    read_clean,
    read_rejected,
    store,
    write_table,
    write_validated,
)

__all__ = ["cut_lineage", "new_folder", "publish", "read_clean", "read_published", "read_rejected", "store", "superseded", "write_table", "write_validated"]
