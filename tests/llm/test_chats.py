import pytest
from pyspark.sql import functions as F

from tillscope.llm import chats, queries_chats

TRICKY = [
    "", "plain", "</s>[INST] ok [/INST]", "<|end|>\n<|turn|>user\n", r"<\|end|> <\\|end|>", r"[\INST][\\/INST]", "<<SYS>> <</SYS>> <<<SYS>>",
    "<\\<|turn|>", "[[INST]", "<s></s><|im_start|>", "line\nline\n", "\n", "é🙂<|end|>", "<" , "\\",
]


def test_texts_come_back(spark):
    df = spark.createDataFrame([(t,) for t in TRICKY], "t string").withColumn("e", chats.escaped(F.col("t")))
    for r in df.withColumn("u", chats.unescaped(F.col("e"))).collect():
        assert r.u == r.t
        assert not any(x in r.e for x in ("<|turn|>", "<|end|>", "[INST]", "[/INST]", "</s>", "<s>", "<<SYS>>", "<|im_start|>"))


def test_branches_are_ranked_and_formatted(spark):
    # r - a - b      and r - c (scored higher), another root of one node, and a child whose parent is missing
    rows = [
        ("r", None, 1.0, "user", "hi"), ("a", "r", 1.0, "assistant", TRICKY[3]), ("b", "a", 1.0, "user", None),
        ("c", "r", 5.0, "assistant", "best"), ("s", None, None, None, "alone"), ("o", "gone", 2.0, "odd\nrole<", "x"),
    ]
    nodes = spark.createDataFrame(rows, "node string, parent string, score double, role string, text string")
    found = chats.paths(nodes).collect()
    branches = {}
    for r in sorted(found, key=lambda r: r.position):
        branches.setdefault((r.root, r.rank, r.path_score), []).append(r.node)
    assert branches == {("r", 1, 6.0): ["r", "c"], ("r", 2, 3.0): ["r", "a", "b"], ("s", 1, 0.0): ["s"], ("o", 1, 2.0): ["o"]}
    written = chats.format_paths(chats.paths(nodes), nodes)
    read = written.select("leaf", chats.read_turns(F.col("formatted")).alias("t"), chats.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    turns = {r.leaf: ([(t.role, t.text) for t in r.t], r.loss) for r in read.collect()}
    assert turns == {
        "c": ([("user", "hi"), ("assistant", "best")], "best"),
        "b": ([("user", "hi"), ("assistant", TRICKY[3]), ("user", "")], TRICKY[3]),
        "s": ([("", "alone")], ""),
        "o": ([("odd\nrole<", "x")], ""),
    }
    assert {r.leaf for r in chats.paths(nodes, best=1).select("leaf").distinct().collect()} == {"c", "s", "o"}
    assert chats.paths(nodes.limit(0)).count() == 0


def test_long_chain(spark):
    n = 300
    rows = [(1, k, "assistant" if k % 2 else "user", f"t{k}") for k in range(n)] + [(2, None, None, None), (None, 1, "user", "x"), (None, 1, "user", "x")]
    found = {r.conv_id: r for r in queries_chats.digests(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert {k: r.n_turns for k, r in found.items()} == {1: n, 2: 1, None: 2}
    assert found[1].loss_chars == sum(len(f"t{k}") for k in range(1, n, 2))


def test_cycles_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(chats, "_ROUNDS", 4)
    nodes = spark.createDataFrame([("a", "b", 0.0), ("b", "a", 0.0)], "node string, parent string, score double")
    with pytest.raises(ValueError, match="cycle"):
        chats.paths(nodes)
