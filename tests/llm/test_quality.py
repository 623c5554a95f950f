from collections import Counter

from pyspark.sql import functions as F

from blocklake.llm.quality import quality_rules
from tests.llm.fixtures import corpus, docs, spaced


def brute(text):
    text = text or ""
    w = spaced(text)
    tri = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if spaced(x)]
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_figures_are_those_of_brute_force(spark):
    got = quality_rules(docs(spark)).collect()
    want = Counter((r[0], r[1], *brute(r[1])) for r in corpus())
    assert Counter((r.doc_id, r.text, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_lines_fail_before_documents(spark):
    prose = "\n".join(f"Sentence{i} tells{i} of rivers{i}, lakes{i} and seas{i} in{i} the north{i}." for i in range(12))
    junk = "\n".join(["Home | About | Contact | Imprint"] * 3 + ["We use cookies to make this site better."])
    rows = [(1, prose, "en", "s", 0), (2, f"{prose}\n{junk}", "en", "s", 0), (3, "\n".join(f"Link{i} | Other{i} | More{i} | Last{i}" for i in range(30)), "en", "s", 0)]
    got = {r.doc_id: r for r in quality_rules(docs(spark, rows)).collect()}
    assert got[1].kept and got[1].clean_text == prose and got[1].lost_words == 0
    assert got[2].kept and got[2].clean_text == prose
    assert not got[3].kept and not got[3].base_failed and got[3].clean_text == ""


def test_empty_table_and_no_python(spark):
    df = quality_rules(docs(spark, []))
    assert df.count() == 0
    assert "Python" not in df._jdf.queryExecution().toString() and "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_a_column_with_our_own_name_stays(spark):
    got = quality_rules(docs(spark).withColumn("_f", F.lit("own")).withColumn("_F_", F.lit("too")).withColumn("kept", F.lit("replaced"))).collect()
    assert {(r["_f"], r["_F_"]) for r in got} == {("own", "too")} and all(isinstance(r.kept, bool) for r in got)
