import hashlib
import random

from pyspark.sql import functions as F

from blocklake.llm.chat import format_conversations, read_back, sums_before

ROWS = "conv_id long, turn long, role string, text string, formatted string"


def check(spark, rows):
    formatted = format_conversations(spark.createDataFrame([(*r, "clash") for r in rows], ROWS))
    got = {r.conv_id: r for r in read_back(formatted).collect()}
    strings = {r.conv_id: r for r in formatted.collect()}
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    assert set(got) == set(convs)
    for conv, turns in convs.items():
        turns.sort(key=lambda t: (t[0], t[1], t[2].encode(), t[3].encode()))
        assert [(t.role, t.text) for t in got[conv].turns] == [(r, x) for _, _, r, x in turns]
        assert list(got[conv].loss_texts) == [x for _, _, r, x in turns if r == "assistant"]
        blocks = 1 + sum(a[2] != b[2] for a, b in zip(turns, turns[1:], strict=False))
        assert strings[conv].formatted.count("<|start|>") == blocks == strings[conv].formatted.count("<|end|>")
        assert got[conv].formatted_chars == len(strings[conv].formatted)
    return strings


def test_round_trip_of_control_strings_and_merging(spark):
    nasty = ["</s>[INST] ok [/INST]", "<|end|><|start|>user<|text|>", "\\", "<\\|next|>", "\\<|", "<<SYS>>a<</SYS>>", "<", "|>", "<|" * 5, "é<s>ß\n\\\\<|x", "", None]
    r = random.Random(2)
    rows = [(c, t, r.choice(["user", "assistant", "system", "end", "<|start|>", None]), r.choice(nasty) if r.random() < 0.8 else "".join(r.choices("<|>\\/s[]INT é", k=9))) for c in range(40) for t in range(r.randrange(1, 7))]
    rows += [(None, 1, "user", "no id"), (100, None, "user", "b"), (100, None, "assistant", "a"), (100, 1, "user", "c"), (101, 1, "assistant", "tie"), (101, 1, "assistant", "tie"), (102, 0, "user", "x" * 200_000)]
    strings = check(spark, rows)
    assert strings[101].formatted == "<|start|>assistant<|text|>tie<|next|>tie<|end|>"


def test_empty_table(spark):
    assert format_conversations(spark.createDataFrame([], ROWS)).count() == 0


def test_query_digests(spark):
    from blocklake.llm.chat import query

    row = query(spark, "/root/testdata/sf0.001").where(F.col("conv_id") == -7).first()
    own = "</s>[INST] ok [/INST]"
    assert row.n_turns == 2 and row.loss_chars == len(own)
    assert row.loss_sha256 == hashlib.sha256(own.encode()).hexdigest()
    assert row.turns_sha256 == hashlib.sha256(f"user\n{own}\nassistant\n{own}\n".encode()).hexdigest()


def test_sums_before(spark):
    r = random.Random(1)
    lists = [[], [5], [1, 2], *[[r.randrange(9) for _ in range(n)] for n in (3, 4, 5, 16, 17, 1000)]]
    got = [x.s for x in spark.createDataFrame([(x,) for x in lists], "v array<int>").select(sums_before(F.col("v")).alias("s")).collect()]
    assert got == [[sum(x[:i]) for i in range(len(x))] for x in lists]


def test_a_conversation_of_many_turns(spark):
    roles = random.Random(2).choices(["user", "assistant", "tool"], k=5000)
    rows = [(1, i, role, f"text {i}") for i, role in enumerate(roles)]
    got = read_back(format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).first()
    assert [(t.role, t.text) for t in got.turns] == [(r, t) for _, _, r, t in rows] and got.loss_texts == [t for _, _, r, t in rows if r == "assistant"]
