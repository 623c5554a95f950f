"""Stateful streams over files, run to their end."""

from __future__ import annotations

import json
import os
import random
from collections import Counter

from blocklake.operators import ingest
from blocklake.plans.chains.raw import RAW
from blocklake.plans.tables import raw_schema
from blocklake.sources import layout, sinks
from blocklake.sources.layout import read_table
from blocklake.streaming import stream as S

SCHEMA = "chain string, number long, hash string, parent_hash string, ts timestamp, transactions array<struct<hash:string>>"


def feed(spark, path, rows):
    path.mkdir(exist_ok=True)
    (path / f"{len(list(path.iterdir()))}.json").write_text("\n".join(json.dumps(dict(zip(("chain", "number", "hash", "parent_hash", "ts", "transactions"), r, strict=True))) for r in rows))
    return S.stream_raw_blocks(spark, str(path), SCHEMA)


def drain(df, name, tmp_path, mode="append"):
    df.sparkSession.conf.set(*S.STATE_STORE)
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", f"{tmp_path}/{name}").trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name).collect()


def block(n, parent=None, chain="c"):
    return (chain, n, f"h{n}", parent or f"h{n - 1}", f"2024-01-01T00:00:{n:02d}Z", [{"hash": f"t{n}"}])


def test_finality_and_continuity(spark, tmp_path):
    stream = feed(spark, tmp_path / "in", [block(n) for n in (1, 2, 3)] + [block(4, "bad"), block(5), block(1, chain="d")])
    got = drain(S.finalized_stream(stream, 2), "final", tmp_path)
    assert sorted((r.chain, r.number, r.hash) for r in got) == [("c", 1, "h1"), ("c", 2, "h2"), ("c", 3, "h3")]
    bad = drain(S.continuity_stream(stream, seed={"c": (0, "h0")}), "bad", tmp_path)
    assert [(r.number, r.expected, r.actual, r.kind) for r in bad] == [(4, "h3", "bad", "broken")]
    # the state goes on with files that come later
    feed(spark, tmp_path / "in", [block(6), block(7)])
    assert sorted(r.number for r in drain(S.finalized_stream(stream, 2), "final2", tmp_path)) == [1, 2, 3, 4, 5]


def test_repeats_resume_and_ingest(spark, tmp_path):
    stream = feed(spark, tmp_path / "in", [block(1), block(2), block(2), block(3)])
    assert sorted(r.number for r in drain(S.dedupe_blocks(stream), "once", tmp_path)) == [1, 2, 3]
    assert sorted(r.number for r in drain(S.resume(stream, 3), "resumed", tmp_path)) == [3]
    S.ingest_stream(stream, f"{tmp_path}/ck", lambda df: ingest.flatten_blocks(df, {"transactions": "transactions"}), f"{tmp_path}/out").awaitTermination()
    assert sorted(r.hash for r in spark.read.parquet(f"{tmp_path}/out/transactions").collect()) == ["t1", "t2", "t2", "t3"]


def test_finality_of_batches(spark):
    df = spark.createDataFrame([("a", n) for n in range(8)] + [("b", n) for n in range(3)], "chain string, number long")
    assert sorted(r.number for r in S.finalized(df.where("chain = 'a'"), 5).collect()) == [0, 1, 2]
    assert sorted((r.chain, r.number) for r in S.finalized(df, 2, "chain").collect()) == [*[("a", n) for n in range(6)], ("b", 0)]
    assert "Cartesian" not in S.finalized(df, 5)._jdf.queryExecution().executedPlan().toString()


def stepwise(spark, tmp_path, make, batches):
    """Rows that each batch adds, the stream stopped and begun again after each."""
    seen, out = Counter(), []
    for batch in batches:
        stream = feed(spark, tmp_path / "in", batch)
        rows = Counter(tuple(r) for r in S.run_to_end(make(stream), f"{tmp_path}/out", f"{tmp_path}/ck").collect())
        out.append(sorted((rows - seen).elements(), key=repr))
        seen = rows
    return out


def test_finality_of_repeats_forks_and_late_heights(spark, tmp_path):
    b = lambda n, h=None: ("c", n, h or f"h{n}", None, None, None)
    got = stepwise(spark, tmp_path, lambda s: S.finality_stream(s, 2), [
        [b(1), b(3), b(5)],  # 2 and 4 are missing
        [b(1), b(3), b(5)],  # all again: nothing
        [b(5, "x5"), b(2), b(6)],  # another tip, a late height, and one more
        [b(5), b(3, "y3"), b(8), b(1)],  # the first tip again: it still waits; a conflict with what is put out
        [b(5, "x5"), b(8), b(10)],
    ])
    kinds = [[(r[1], r[2], r[3], r[4]) for r in rows] for rows in got]
    assert kinds == [
        [(1, "h1", "final", None), (3, "h3", "final", None)], [], [(2, "h2", "late", None), (5, "x5", "replaced", "h5")],
        [(3, "h3", "conflict", "y3"), (5, "h5", "final", None), (5, "h5", "replaced", "x5"), (6, "h6", "final", None)], [(5, "h5", "conflict", "x5"), (8, "h8", "final", None)],
    ]


def test_finality_without_depth(spark, tmp_path):
    b = lambda n: ("c", n, f"h{n}", None, None, None)
    got = stepwise(spark, tmp_path, lambda s: S.finalized_stream(s, 0), [[b(1), b(2)], [b(2), b(3)], [b(1), b(3)]])
    assert [[r[1] for r in rows] for rows in got] == [[1, 2], [3], []]


def test_continuity_over_batches_in_any_order(spark, tmp_path):
    b = lambda n, h=None, p=None: ("c", n, h or f"h{n}", p or f"h{n - 1}", None, None)
    got = stepwise(spark, tmp_path, lambda s: S.continuity_stream(s, seed={"c": (0, "h0")}, patience=4), [
        [b(2), b(1), b(4)],  # 3 is still to come
        [b(3), b(5), b(2)],  # there it is; 2 again
        [b(7, p="bad"), b(7, "x7", "h6"), b(6)],  # a height with two hashes: the later one counts
        [b(9, p="wrong"), b(7, "y7")],  # 8 is missing; the last one reached has another hash
        [b(10), b(12)],  # the stream is patience heights beyond 7: a gap, and it goes on
        [b(8), b(11), b(13, p="off")],
    ])
    kinds = [[(r[1], r[2], r[3], r[4]) for r in rows] for rows in got]
    assert kinds == [[], [], [(7, "h7", "x7", "fork")], [(7, "x7", "y7", "fork")], [(9, "8", "9", "gap")], [(13, "h12", "off", "broken")]]


def test_rolling_ingest_survives_a_stop_anywhere(spark, tmp_path, monkeypatch):
    """Blocks over several batches, one batch twice; stopped within a chunk, after a chunk's rename, and before the clean-up."""
    raw = RAW["substrate"]
    make = lambda n: {"header": {"height": n, "hash": f"0xh{n:05d}", "parentHash": f"0xh{n - 1:05d}"}, "events": [{"index": i, "name": "E" * (n % 7), "args": {"n": n}, "phase": "x"} for i in range(n % 4)]}
    source, root, work = tmp_path / "in", str(tmp_path / "lake"), str(tmp_path / "work")
    source.mkdir()
    for k, heights in enumerate([range(0, 9), range(9, 20), range(15, 24), range(24, 30)]):
        (source / f"{k}.json").write_text("".join(json.dumps(make(n)) + "\n" for n in heights))
        os.utime(source / f"{k}.json", (1_700_000_000 + k, 1_700_000_000 + k))  # files come in this order
    stream = lambda: spark.readStream.schema(raw_schema(raw)).option("maxFilesPerTrigger", 1).json(str(source))
    write, calls = sinks.write_lake, []

    def stopped(tables, specs, chunks, *a, **k):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("stopped before any chunk")
        write(tables, specs, chunks.orderBy("chunk").limit(1) if len(calls) == 2 else chunks, *a, **k)
        if len(calls) in (2, 3):
            raise RuntimeError("stopped after chunks were moved")

    monkeypatch.setattr(sinks, "write_lake", stopped)
    for _ in range(6):
        try:
            S.rolling_ingest(stream(), raw, root, work, chunk_bytes=700, top_dir_size=2)
            break
        except Exception as e:  # noqa: BLE001
            assert "stopped" in str(e)
    assert len(calls) > 3
    assert sorted(r.number for r in read_table(spark, root, "blocks").collect()) == list(range(30))
    assert Counter(r.block_number for r in read_table(spark, root, "events").collect()) == Counter({n: n % 4 for n in range(30) if n % 4})
    found = layout.chunk_catalog(spark, root).orderBy("first_block").collect()
    assert len(found) > 3 and all(a.last_block + 1 == b.first_block for a, b in zip(found, found[1:], strict=False)) and layout.validate_layout(layout.chunk_catalog(spark, root)).count() == 0
    assert [r.top for r in found] == [found[k // 2 * 2].first_block for k in range(len(found))] and all(r.last_hash == f"{r.last_block:05d}" for r in found)
    S.rolling_ingest(stream(), raw, root, work, chunk_bytes=700, top_dir_size=2)  # nothing new
    assert layout.chunk_catalog(spark, root).count() == len(found)


def test_sample_rates_are_those_of_a_fold(spark, tmp_path):
    """Irregular and idle times, repeats, heights that fall, reports too late."""
    rng = random.Random(5)
    at, batches = 0, []
    for _ in range(5):
        rows = []
        for _ in range(40):
            at += rng.choice([0, 100, 300, 900, 1000, 1001, 2500, 60_000])
            rows.append((rng.choice("ab"), at // 300 + rng.randrange(-3, 4), at - rng.choice([0, 0, 0, 5000])))
        batches.append(rows)
    batches[1].append((None, 3, 10)), batches[2].append(("a", None, at)), batches[3].append(("only", 7, 3))
    want = []
    rings = {}
    for rows in batches:
        for c in sorted({r[0] for r in rows}, key=str):
            ring = rings.setdefault(c, [])
            for t, n in sorted((t, n) for k, n, t in rows if k == c and n is not None):
                if ring and (n := max(n, ring[-1][0])) is not None and t <= ring[-1][1] + (1000 if len(ring) > 1 else 0):
                    ring[-1] = (n, ring[-1][1])
                else:
                    ring.append((n, t))
            last = ring[-11:]
            want.append((c, last[-1][0], last[-1][1] * 1000, len(last), round((last[-1][0] - last[0][0]) / max(1, last[-1][1] - last[0][1]) * 1e9)))
    schema, seen = "chain string, number long, ts timestamp", Counter()
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, "chain string, number long, ms long").selectExpr("chain", "number", "timestamp_millis(ms) AS ts").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        out = S.run_to_end(S.sample_rate_stream(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), "number", "ts", "chain"), f"{tmp_path}/out", f"{tmp_path}/ck")
        seen = Counter((r.chain, r.number, round(r.at * 1_000_000), r.samples, round(r.rate * 1_000_000)) for r in out.collect())
    assert seen == Counter(want)


def test_sample_rates_of_nothing(spark, tmp_path):
    spark.createDataFrame([], "chain string, number long, ts timestamp").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("chain string, number long, ts timestamp").parquet(f"{tmp_path}/in")
    assert S.run_to_end(S.sample_rate_stream(stream, "number", "ts", "chain"), f"{tmp_path}/out", f"{tmp_path}/ck").count() == 0
