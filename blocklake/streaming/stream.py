"""Streams of blocks: finality, continuity, rates, delays, repeats, and writing as they come."""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor


def stream_raw_blocks(spark: SparkSession, path: str, schema, next_block: int = 0, number: str = "number") -> DataFrame:
    """New lines of JSON files as they arrive, from a height on; offsets are in the query's checkpoint."""
    return spark.readStream.schema(schema).json(path).where(F.col(number) >= next_block)


def resume(stream: DataFrame, next_block: int, number: str = "number") -> DataFrame:
    """Only heights that the stored layout does not have yet."""
    return stream.where(F.col(number) >= next_block)


def finalized(df: DataFrame, depth: int, chain: str | None = None, number: str = "number") -> DataFrame:
    """Rows at least ``depth`` heights below the tip of their chain (a batch; see finalized_stream)."""
    tip = (F.max(number) - depth).alias("_tip")
    if not chain:
        return df.where(F.col(number) <= df.agg(tip).scalar())
    return df.join(df.groupBy(chain).agg(tip), chain).where(F.col(number) <= F.col("_tip")).drop("_tip")


#: Heights whose rows are one value of a map state: a call to the state costs some hundred times as much as a row in memory.
STRETCH = 2048
#: Rows that are put in order at once, rows of the state that are held in memory, and rows that are put out at once.
HELD = 200_000


class _Stretches:
    """Rows by height in a map state, a stretch of heights a value; those in use are held in memory and written at the end."""

    def __init__(self, state):
        self.state, self.rows, self.changed, self.held = state, {}, set(), 0
        self.stored = {k[0] for k in state.keys()}

    def at(self, stretch: int, change: bool = True) -> dict[int, list]:
        """The rows of a stretch by height, to be used until the next call."""
        if (found := self.rows.get(stretch)) is None:
            if self.held > HELD:
                self.write()
            found = {n: row for n, *row in json.loads(self.state.getValue((stretch,))[0])} if stretch in self.stored else {}
            self.rows[stretch] = found
            self.held += len(found)
        if change:
            self.changed.add(stretch)
        return found

    def stretches(self) -> list[int]:
        """All that may have rows, in order."""
        return sorted(self.stored | self.rows.keys())

    def write(self) -> None:
        for k in self.changed:
            if rows := self.rows[k]:
                self.state.updateValue((k,), (json.dumps([[n, *row] for n, row in rows.items()]),))
                self.stored.add(k)
            elif k in self.stored:
                self.state.removeKey((k,))
                self.stored.discard(k)
        self.rows, self.changed, self.held = {}, set(), 0


def _by_stretch(frames: Iterator[pd.DataFrame], columns: list[str]) -> Iterator[tuple[int, list[tuple]]]:
    """Rows of a stretch of heights after the other, those of one in order of arrival; a batch beyond HELD rows comes part after part."""

    def parts():
        held, n = [], 0
        for pdf in frames:
            held.append(pdf[columns])
            n += len(pdf)
            if n >= HELD:
                yield pd.concat(held)
                held, n = [], 0
        if n:
            yield pd.concat(held)

    for pdf in parts():
        at = pdf[columns[0]].to_numpy() // STRETCH
        order = np.argsort(at, kind="stable")
        at, pdf = at[order], pdf.iloc[order]
        cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(at)]
        values = [pdf[c].tolist() for c in columns]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield int(at[a]), list(zip(*(v[a:b] for v in values), strict=True))


class _Finality(StatefulProcessor):
    """Of one chain: blocks that wait by height, the tip, and the hashes of the last heights that were put out."""

    def __init__(self, depth: int, chain: str, number: str):
        self.depth, self.chain, self.number = depth, chain, number

    def init(self, handle) -> None:
        self.waiting = handle.getMapState("waiting", "stretch long", "rows string")
        self.done = handle.getMapState("done", "stretch long", "rows string")
        self.ends = handle.getValueState("ends", "tip long, final long")

    def handleInputRows(self, key, rows, timers):  # noqa: N802
        tip, final = self.ends.get() if self.ends.exists() else (None, None)
        waiting, done, out = _Stretches(self.waiting), _Stretches(self.done), []
        frame = lambda: pd.DataFrame(out, columns=[self.chain, self.number, "hash", "kind", "other"])
        for stretch, part in _by_stretch(rows, [self.number, "hash"]):
            wait = waiting.at(stretch)
            known = done.at(stretch) if final is not None and stretch * STRETCH <= final else None
            before = len(wait)
            for n, own in part:
                n = int(n)
                if final is not None and n <= final:  # put out already: the same block again is nothing new
                    if n in known:
                        if known[n][0] != own:
                            out.append((key[0], n, known[n][0], "conflict", own))
                    elif n >= final - self.depth:
                        out.append((key[0], n, own, "late", None))
                        known[n] = [own]
                    continue
                if n in wait and wait[n][0] != own:
                    out.append((key[0], n, own, "replaced", wait[n][0]))
                wait[n] = [own]
                tip = n if tip is None else max(tip, n)
            waiting.held += len(wait) - before
            if len(out) >= HELD:
                yield frame()
                out.clear()
        if tip is not None:
            last = deque()  # what is put out now, as far as it is to be remembered
            for stretch in waiting.stretches():
                if stretch * STRETCH > tip - self.depth:
                    break
                wait = waiting.at(stretch)
                for n in sorted(x for x in wait if x <= tip - self.depth):
                    (own,) = wait.pop(n)
                    out.append((key[0], n, own, "final", None))
                    last.append((n, own))
                    while last[0][0] < n - self.depth:
                        last.popleft()
                    final = n if final is None else max(final, n)
                if len(out) >= HELD:
                    yield frame()
                    out.clear()
            for n, own in last:
                done.at(n // STRETCH)[n] = [own]
            for stretch in done.stretches():
                if final is None or stretch * STRETCH >= final - self.depth:
                    break
                known = done.at(stretch)
                for n in [x for x in known if x < final - self.depth]:
                    del known[n]
            self.ends.update((tip, final))
        waiting.write()
        done.write()
        yield frame()


def finality_stream(stream: DataFrame, depth: int, chain: str = "chain", number: str = "number") -> DataFrame:
    """``chain, number, hash, kind, other`` of a stream of ``chain, number, hash``.

    ``final``: a block that lies ``depth`` or more below its chain's tip, once, in order of height within a batch. ``replaced``: a
    block took the place of one that still waited (``other``). ``conflict``: a block (``other``) came at a height that was put
    out with another hash. ``late``: a height below the last final one came for the first time. Hashes are remembered ``depth``
    heights below the last final one; what comes at a height below that, and a block that comes again, waiting or put out, is
    nothing new. State is a value a stretch of STRETCH heights that has rows, so a batch rewrites only the stretches it touches.
    """
    schema = f"{chain} string, {number} long, hash string, kind string, other string"
    return stream.groupBy(chain).transformWithStateInPandas(_Finality(depth, chain, number), schema, "Append", "None")


def finalized_stream(stream: DataFrame, depth: int, chain: str = "chain", number: str = "number") -> DataFrame:
    """``chain, number, hash`` of each block once it lies ``depth`` below its chain's tip; see :func:`finality_stream`."""
    return finality_stream(stream, depth, chain, number).where("kind = 'final'").select(chain, number, "hash")


class _Continuity(StatefulProcessor):
    """Of one chain: the last block that all before it have come to, and those above it that wait for a height."""

    def __init__(self, chain: str, number: str, seed: dict[str, tuple[int, str]], patience: int):
        self.chain, self.number, self.seed, self.patience = chain, number, seed, patience

    def init(self, handle) -> None:
        self.waiting = handle.getMapState("waiting", "stretch long", "rows string")
        self.last = handle.getValueState("last", "number long, hash string")

    def handleInputRows(self, key, rows, timers):  # noqa: N802
        at, last = self.last.get() if self.last.exists() else self.seed.get(key[0], (None, None))
        waiting, out = _Stretches(self.waiting), []
        frame = lambda: pd.DataFrame(out, columns=[self.chain, self.number, "expected", "actual", "kind"])
        for stretch, part in _by_stretch(rows, [self.number, "hash", "parent_hash"]):
            wait = waiting.at(stretch)
            before = len(wait)
            for n, own, parent in part:
                n = int(n)
                if at is not None and n <= at:
                    if n == at and own != last:
                        out.append((key[0], n, last, own, "fork"))
                    continue
                if n in wait and wait[n][0] != own:
                    out.append((key[0], n, wait[n][0], own, "fork"))
                wait[n] = [own, parent]
            waiting.held += len(wait) - before
            if len(out) >= HELD:
                yield frame()
                out.clear()
        stretches = waiting.stretches()
        top = next((max(wait) for k in reversed(stretches) if (wait := waiting.at(k, change=False))), None)
        missing = False
        for stretch in stretches:
            wait = waiting.at(stretch, change=False)
            for n in sorted(wait):
                if at is not None and n > at + 1:
                    if missing := top - at <= self.patience:
                        break  # what is missing may still come
                    out.append((key[0], n, str(at + 1), str(n), "gap"))
                own, parent = wait.pop(n)
                waiting.changed.add(stretch)
                if last is not None and n == at + 1 and parent != last:
                    out.append((key[0], n, last, parent, "broken"))
                at, last = n, own
            if missing:
                break
            if len(out) >= HELD:
                yield frame()
                out.clear()
        if at is not None:
            self.last.update((at, last))
        waiting.write()
        yield frame()


def continuity_stream(stream: DataFrame, chain: str = "chain", number: str = "number", seed: dict[str, tuple[int, str]] | None = None, patience: int = 100) -> DataFrame:
    """``chain, number, expected, actual, kind`` of what is wrong in a stream of ``chain, number, hash, parent_hash``.

    ``broken``: a block's parent is not the block below it. ``fork``: a height came with two hashes, the last one reached or one that
    waits (the later one then counts). ``gap``: heights from ``expected`` up to ``actual`` did not come although the stream went
    ``patience`` heights beyond the last one reached; it goes on from there. Heights may come in any order within that patience, over
    any number of batches; what comes again is nothing new. ``seed``: height and hash stored before, by chain; without one
    a chain begins with the least height of its first batch.
    """
    schema = f"{chain} string, {number} long, expected string, actual string, kind string"
    return stream.groupBy(chain).transformWithStateInPandas(_Continuity(chain, number, seed or {}, patience), schema, "Append", "None")


#: The state store that map states need.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def run_to_end(stream: DataFrame, dest: str, checkpoint: str) -> DataFrame:
    """Writes all that a stream has so far to Parquet files and reads them: begun again with the same folders it goes on where it was."""
    spark = stream.sparkSession
    before = spark.conf.get(STATE_STORE[0], None)
    spark.conf.set(*STATE_STORE)
    try:
        stream.writeStream.format("parquet").option("path", dest).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.unset(STATE_STORE[0]) if before is None else spark.conf.set(STATE_STORE[0], before)
    return spark.read.schema(stream.schema).parquet(dest)


def dedupe_blocks(stream: DataFrame, ts: str = "ts", delay: str = "1 hour", key: tuple[str, ...] = ("chain", "number")) -> DataFrame:
    """Each block once, though a range that was read twice repeats it within ``delay``."""
    if not stream.isStreaming:
        return stream.dropDuplicates(list(key))
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(key))


def progress_rate(df: DataFrame, number: str, ts: str, chain: str, window: str = "10 seconds", slide: str = "1 second", seconds: int = 10, delay: str = "1 minute") -> DataFrame:
    """``chain, start, rate``: heights a second in sliding windows."""
    rows = df.withWatermark(ts, delay) if df.isStreaming else df
    return rows.groupBy(F.col(chain).alias("chain"), F.window(ts, window, slide)).agg(((F.max(number) - F.min(number)) / seconds).alias("rate")).select("chain", F.col("window.start").alias("start"), "rate")


class _Samples(StatefulProcessor):
    """Of one chain: the last samples of its progress, oldest first."""

    def __init__(self, chain: str, keep: int, gap: float):
        self.chain, self.keep, self.gap = chain, keep, gap

    def init(self, handle) -> None:
        self.ring = handle.getListState("ring", "number long, at double")

    def handleInputRows(self, key, rows, timers):  # noqa: N802
        ring = [[r[0], r[1]] for r in self.ring.get()] if self.ring.exists() else []
        seen = pd.concat([pdf[["number", "at"]] for pdf in rows]).dropna().sort_values(["at", "number"])
        for n, at in zip(seen["number"].tolist(), seen["at"].tolist(), strict=True):
            if not ring:
                ring.append([int(n), at])
                continue
            last = ring[-1]
            n = max(int(n), last[0])
            if at <= last[1] + (self.gap if len(ring) > 1 else 0):
                last[0] = n
            else:
                ring = [*ring, [n, at]][-self.keep :]
        if ring:
            self.ring.put([tuple(r) for r in ring])
            (n0, t0), (n1, t1) = ring[0], ring[-1]
            yield pd.DataFrame([(key[0], n1, t1, len(ring), (n1 - n0) / (t1 - t0) if len(ring) > 1 else 0.0)], columns=[self.chain, "number", "at", "samples", "rate"])


def sample_rate_stream(stream: DataFrame, number: str, ts: str, chain: str, samples: int = 10, gap: float = 1.0) -> DataFrame:
    """``chain, number, at, samples, rate`` after each batch: heights a second over the last ``samples`` intervals between samples.

    A report (a height and when it was seen) makes a new sample if it comes more than ``gap`` seconds after the last one, else it only
    raises the last one's height; the second sample may come at any time after the first. So times without reports count in full, and
    heights never fall. A batch's reports count in order of time; what comes later with an earlier time raises the last sample. ``at`` is
    the last sample's time in seconds; one sample has the rate 0; reports with a null are no reports. State is ``samples + 1`` pairs a chain.
    """
    seen = F.unix_micros(F.col(ts).cast("timestamp")) / 1_000_000
    reports = stream.select(F.col(chain).cast("string").alias("chain"), F.col(number).cast("long").alias("number"), seen.alias("at"))
    schema = "chain string, number long, at double, samples int, rate double"
    return reports.groupBy("chain").transformWithStateInPandas(_Samples("chain", samples + 1, gap), schema, "Append", "None")


def delivery_delay(df: DataFrame, number: str, made: str, seen: str, chain: str) -> DataFrame:
    """``chain, latest, latest_seconds, worst_seconds``: how long after they were made blocks were seen."""
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    late = (micros(seen) - micros(made)) / 1_000_000
    return df.withColumn("_late", late).groupBy(F.col(chain).alias("chain")).agg(F.max(number).alias("latest"), F.max_by("_late", number).alias("latest_seconds"), F.max("_late").alias("worst_seconds"))


def ingest_stream(stream: DataFrame, checkpoint: str, flatten: Callable[[DataFrame], dict[str, DataFrame]], dest: str, available_now: bool = True):
    """Flattens each batch and writes its tables under ``dest/<table>/batch=<id>``; a batch that is done again replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        for name, table in flatten(batch).items():
            table.write.mode("overwrite").parquet(f"{dest}/{name}/batch={batch_id}")
        batch.unpersist()

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def roll_chunks(spark: SparkSession, raw, root: str, work: str, schema, chunk_bytes: int, top_dir_size: int = 500, flush: bool = False) -> int:
    """Moves whole chunks from the buffer below ``work`` to the lake below ``root``; how many. With ``flush`` the last one too, however small.

    What the lake has decides where the next chunk begins, and chunks appear by one rename each, so a run that ended anywhere is
    taken up by the next one, with the same bounds. A height that was buffered twice counts as it came last. Rows a chunk, not
    blocks, reach the driver.
    """
    from blocklake.operators.budget import roll
    from blocklake.plans.tables import KINDS, ingest
    from blocklake.sources import layout, sinks
    from blocklake.sources.shared import stored

    known = layout.chunk_catalog(spark, root)
    have = known.agg(F.count("*").alias("n"), F.max("last_block").alias("last"), F.max("top").alias("top")).first()
    place, _, _ = raw.height.rpartition(".")
    member = lambda name: F.col(f"{place}.{name}" if place else name)
    height = KINDS[raw.height_kind][1](F.col(raw.height)).cast("long")
    buffered = spark.read.schema(f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in schema)}, batch long").parquet(f"{work}/buffer").withColumn("block_number", height)
    open_rows = buffered.where(F.col("block_number") > have["last"]) if have["last"] is not None else buffered
    latest = Window.partitionBy("block_number").orderBy(F.desc("batch"))
    blocks = open_rows.withColumn("_nth", F.row_number().over(latest)).where("_nth = 1").drop("_nth", "batch").withColumn("_bytes", F.octet_length(F.to_json(F.struct(*[f"`{f.name}`" for f in schema]))))
    rolled = stored(roll(blocks, chunk_bytes, "_bytes", "chunk"), "rolled")
    digits = F.right(member("hash"), F.lit(5))
    ends = rolled.groupBy("chunk").agg(F.min("block_number").alias("first_block"), F.max("block_number").alias("last_block"), F.max_by(digits, "block_number").alias("last_hash"), F.sum("_bytes").alias("bytes")).orderBy("chunk").collect()
    whole = [r for r in ends if flush or r["bytes"] > chunk_bytes]
    if whole:
        top, rows = have["top"], []
        for k, r in enumerate(whole, have["n"]):
            top = r["first_block"] if k % top_dir_size == 0 else top
            rows.append((r["chunk"], top, r["first_block"], r["last_block"], r["last_hash"]))
        chunks = spark.createDataFrame(rows, "chunk long, top long, first_block long, last_block long, last_hash string")
        chunk_of = rolled.where(F.col("chunk") <= whole[-1]["chunk"]).select(F.col("block_number").cast("int").alias("_n"), "chunk")
        own = ingest(raw, rolled.where(F.col("chunk") <= whole[-1]["chunk"]).select(*[f"`{f.name}`" for f in schema]), keep=False)
        tables = {n: t.join(chunk_of, t["number" if n == "blocks" else "block_number"] == chunk_of["_n"]).drop("_n") for n, t in own.items()}
        sinks.write_lake(tables, raw.model.tables | {"blocks": raw.model.block}, chunks, root, rules={r.table: r for r in raw.tables})
    done = whole[-1]["last_block"] if whole else have["last"]
    if done is not None:  # batches that are in the lake whole
        path = spark._jvm.org.apache.hadoop.fs.Path
        fs = path(work).getFileSystem(spark._jsc.hadoopConfiguration())
        for r in buffered.groupBy("batch").agg(F.max("block_number").alias("n")).where(F.col("n") <= done).toLocalIterator():  # names
            fs.delete(path(f"{work}/buffer/batch={r['batch']}"), True)
    return len(whole)


def rolling_ingest(stream: DataFrame, raw, root: str, work: str, chunk_bytes: int = 1 << 30, top_dir_size: int = 500, flush: bool = True) -> None:
    """Raw blocks of a stream, to its end, as chunks of a lake that :func:`blocklake.sources.layout.read_table` reads.

    Blocks wait in a buffer over batches until a chunk of ``chunk_bytes`` of JSON is full; what is left at the end is a chunk of its
    own with ``flush``, or waits for the next run. A batch that is done again replaces itself in the buffer. Batches come in order of
    height but for repeats: what comes at or below the last height of the lake is taken for one. ``work`` holds the buffer and the
    stream's checkpoint and is to be used for this lake alone.
    """
    spark, schema = stream.sparkSession, stream.schema

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{work}/buffer/batch={batch_id}")
        roll_chunks(spark, raw, root, work, schema, chunk_bytes, top_dir_size)

    stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    if flush:
        roll_chunks(spark, raw, root, work, schema, chunk_bytes, top_dir_size, flush=True)
