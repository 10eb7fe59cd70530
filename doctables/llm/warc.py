"""Web archives: records written and read back, and a capture index merged from sorted runs.

Records go to gzip members of WARC files in the shared folder, one file per task and about FILE_BYTES. A task's index entries, sorted by URL key,
time and page, are one run: a Parquet file of small row groups. At most MERGE_WAYS runs meet in a merge, as often as it takes until one is left;
every merge is cut into ranges of about RANGE_ROWS entries at keys the runs gave as samples. A task streams its range's stretch of each run
through a loser tree, a row group of each run at a time, so its memory does not grow with the range. Range k's captures come before range k+1's
and a URL's history is one stretch of the order. Samples set only where ranges end, never which entries they hold.
"""

from __future__ import annotations

import base64
import bisect
import datetime
import itertools
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doctables.llm import shared

#: Payloads below this are never revisits.
LEAST_BYTES = 1000
FILE_BYTES = 256 << 20
BATCH_BYTES = 4 << 20
EPOCH = 1_577_836_800  # capture times are derived from page ids, a second each, from here on
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ENTRY = "url_key string, captured long, page_id long, file string, offset long, size long"
ENTRIES = pa.schema([("url_key", pa.string()), ("captured", pa.int64()), ("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("size", pa.int64())])
#: Runs that meet in one merge, entries of a range, entries and key bytes of a run's row group, samples of a run's file.
MERGE_WAYS = 32
RANGE_ROWS = 1 << 18
GROUP_ROWS = 8192
GROUP_BYTES = 1 << 20
SAMPLES = 16
#: Code points of a URL key that marks (cuts, first and last keys of files) hold.
MARK_CHARS = 256
RUN = "run long, part long, path string, entries long, low string, high string, samples array<string>"
RUNS = pa.schema([("run", pa.int64()), ("part", pa.int64()), ("path", pa.string()), ("entries", pa.int64()), ("low", pa.string()), ("high", pa.string()), ("samples", pa.list_(pa.string()))])


def url_key(url: str | None) -> str:
    """Host labels reversed and comma-joined, `)`, path and query, in lower case; without scheme, `www`, port and fragment."""
    if not url:
        return ""
    try:
        x = urlsplit(url.strip())
        host = (x.hostname or "").removeprefix("www.")
    except ValueError:
        return url.lower()
    return f"{','.join(reversed(host.split('.')))}){x.path or '/'}{'?' + x.query if x.query else ''}".lower()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, captured: int, refers_to: int | None) -> bytes:
    """One gzip member: a response with the payload, or a revisit that names its response."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{page_id}>"]
    head.append(f"WARC-Date: {datetime.datetime.fromtimestamp(captured, datetime.UTC):%Y-%m-%dT%H:%M:%SZ}")
    if url:
        head.append("WARC-Target-URI: " + re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    z = zlib.compressobj(4, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()


def parsed(member: bytes) -> dict:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of a record; a response's payload is checked by its digest."""
    import hashlib

    data = zlib.decompress(member, 31)
    head, _, block = data.partition(b"\r\n\r\n")
    fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    kind = fields[b"WARC-Type"].decode()
    digest = base64.b32decode(fields[b"WARC-Payload-Digest"].partition(b":")[2]).hex()
    if kind == "response" and hashlib.sha1(payload[:length]).hexdigest() != digest:
        raise ValueError("a payload does not match its digest")
    page = lambda x: None if x is None or x == b"<urn:page:None>" else int(x[10:-1])
    return {"page_id": page(fields[b"WARC-Record-ID"]), "payload_bytes": length, "payload_digest": digest, "record_type": kind, "refers_to": page(fields.get(b"WARC-Refers-To"))}


def with_responses(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, payload_digest, refers_to): the page that holds a repeated payload, null where it is the page's own.

    Digests that only one page has leave before the join; Spark splits the task of a digest that many pages share.
    """
    page = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    page = page.withColumn("payload_digest", F.sha1("payload"))
    large = page.filter(F.octet_length("payload") >= LEAST_BYTES)
    holders = large.groupBy("payload_digest").agg(F.max("page_id").alias("holder"), F.count("*").alias("n")).filter("n > 1").select("payload_digest", "holder")
    found = page.join(holders, "payload_digest", "left")
    return found.withColumn("refers_to", F.when(~F.col("holder").eqNullSafe(F.col("page_id")), F.col("holder"))).drop("holder")


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record per page; the index entries, sorted within each task. A task that runs twice leaves files no entry names."""

    def write(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        where = out = None
        number = offset = 0
        for batch in shared.batches_of(it, "payload", BATCH_BYTES):
            rows: dict[str, list] = {c: [] for c in ENTRIES.names}
            for r in batch.to_pylist():
                if out is None or offset > FILE_BYTES:
                    if out is not None:
                        out.close()
                    where, path = shared.file_system(folder)
                    where.create_dir(path, recursive=True)
                    name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{number}.warc.gz"
                    out, number = where.open_output_stream(f"{path}/{name}", compression=None), number + 1
                    info = b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:file:" + name.encode() + b">\r\nContent-Type: application/warc-fields\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
                    z = zlib.compressobj(4, zlib.DEFLATED, 31)
                    info = z.compress(info) + z.flush()
                    out.write(info)
                    offset = len(info)
                captured = EPOCH + max(0, r["page_id"] or 0) % (1 << 36)
                data = record(r["page_id"], r["url"], r["payload"], r["payload_digest"], captured, r["refers_to"])
                out.write(data)
                for c, v in zip(rows, (url_key(r["url"]), captured, r["page_id"], f"{folder}/{name}", offset, len(data))):
                    rows[c].append(v)
                offset += len(data)
            yield pa.RecordBatch.from_pydict(rows, ENTRIES)
        if out is not None:
            out.close()

    return pages.mapInArrow(write, ENTRY).sortWithinPartitions("url_key", "captured", "page_id", "file", "offset")


class LoserTree:
    """Merges sorted iterators of tuples: inner nodes hold the losers of their matches, so the next smallest costs one path."""

    def __init__(self, sources: list[Iterator[tuple]]) -> None:
        self.sources = sources
        self.heads = [next(s, None) for s in sources]
        self.k = len(sources)
        self.tree = [-1] * max(1, self.k)
        for i in range(self.k):
            self._play(i)

    def _wins(self, i: int, j: int) -> bool:
        a, b = self.heads[i], self.heads[j]
        return a is not None and (b is None or (a, i) < (b, j))

    def _play(self, i: int) -> None:
        """Let source i climb; the first to reach a node waits there for its match."""
        node = (i + self.k) // 2
        while node:
            if self.tree[node] < 0:
                self.tree[node] = i
                return
            if self._wins(self.tree[node], i):
                self.tree[node], i = i, self.tree[node]
            node //= 2
        self.tree[0] = i

    def __iter__(self) -> Iterator[tuple]:
        while self.k and self.heads[self.tree[0]] is not None:
            i = self.tree[0]
            yield self.heads[i]
            self.heads[i] = next(self.sources[i], None)
            node = (i + self.k) // 2
            while node:
                if self._wins(self.tree[node], i):
                    self.tree[node], i = i, self.tree[node]
                node //= 2
            self.tree[0] = i


def _mark(key: str, *rest) -> tuple:
    """A tuple at or below the entry in order; whole for keys of MARK_CHARS at most."""
    return (key, *rest) if len(key) <= MARK_CHARS else (key[:MARK_CHARS],)


def _above(key: str, *rest) -> tuple:
    """A tuple at or above the entry in order."""
    return (key, *rest) if len(key) <= MARK_CHARS else (key[:MARK_CHARS] + chr(0x10FFFF),)


def _ordered(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Entries as tuples that compare in the order of the index; a null page is (0, 0) and so comes first."""
    for key, captured, page, *rest in zip(*(batch.column(c).to_pylist() for c in ENTRIES.names)):
        yield key, captured, (0, 0) if page is None else (1, page), *rest


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * 6
    return pa.RecordBatch.from_arrays([pa.array([p if known else None for known, p in c] if f.name == "page_id" else c, f.type) for f, c in zip(ENTRIES, cols)], schema=ENTRIES)


def _batches(entries: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    held = 0
    for e in entries:
        rows.append(e)
        held += len(e[0])
        if len(rows) == GROUP_ROWS or held > GROUP_BYTES:
            yield _batch(rows)
            rows, held = [], 0
    if rows:
        yield _batch(rows)


def _write_run(batches: Iterator[pa.RecordBatch], folder: str, run: int, part: int) -> Iterator[pa.RecordBatch]:
    """Write sorted entries as one Parquet file, a row group a batch; gives the file's row, none if there are no entries."""
    writer = sink = first = last = None
    n, step, samples = 0, 1, []
    path = f"{folder}/run-{run:06d}-{part:06d}-{uuid.uuid4().hex}.parquet"
    for batch in batches:
        if not batch.num_rows:
            continue
        if writer is None:
            where, name = shared.file_system(path)
            where.create_dir(name.rpartition("/")[0], recursive=True)
            sink = where.open_output_stream(name, compression=None)
            writer = pq.ParquetWriter(sink, ENTRIES, compression="zstd")
        writer.write_batch(batch, row_group_size=batch.num_rows)
        samples += [_mark(*e[:5]) for e in _ordered(batch.take(pa.array(range(-n % step, batch.num_rows, step), pa.int64())))]
        ends = pa.concat_batches([batch.slice(0, 1), batch.slice(batch.num_rows - 1)])
        head, last = _ordered(ends)
        first = first or head
        n += batch.num_rows
        while len(samples) > 2 * SAMPLES:  # every step-th entry; the step doubles as the file grows
            samples, step = samples[::2], 2 * step
    if writer is not None:
        writer.close()
        sink.close()
        yield pa.RecordBatch.from_pydict({"run": [run], "part": [part], "path": [path], "entries": [n], "low": [json.dumps(_mark(*first[:5]))], "high": [json.dumps(_above(*last[:5]))], "samples": [[json.dumps(x) for x in samples]]}, RUNS)


def _read_run(paths: list[str], low: tuple | None, high: tuple | None) -> Iterator[tuple]:
    """Entries of a run from low on and below high; row groups that end before or begin after are not read."""
    for path in paths:
        where, name = shared.file_system(path)
        with where.open_input_file(name) as source:
            file = pq.ParquetFile(source)
            for g in range(file.num_row_groups):
                known = file.metadata.row_group(g).column(0).statistics
                if known is not None and known.has_min_max:
                    if low is not None and known.max < low[0]:
                        continue
                    if high is not None and known.min > high[0]:
                        return
                for batch in file.iter_batches(batch_size=GROUP_ROWS, row_groups=[g], use_threads=False):
                    for e in _ordered(batch):
                        if high is not None and e[:5] >= high:
                            return
                        if low is None or e[:5] >= low:
                            yield e


def _loaded(mark: str) -> tuple:
    return tuple(tuple(x) if isinstance(x, list) else x for x in json.loads(mark))


def _cuts(runs: DataFrame, ranges: int) -> list[tuple]:
    """Up to ranges - 1 keys that part the entries evenly, out of the runs' samples.

    Samples are thinned by a hash to about 16 a range and made distinct before they reach the driver, so what it holds
    grows with the number of ranges alone.
    """
    if ranges < 2:
        return []
    marks = runs.select(F.explode("samples").alias("mark"))
    every = max(1, marks.count() // (16 * ranges))
    picked = sorted(_loaded(r.mark) for r in marks.filter(F.pmod(F.xxhash64("mark"), F.lit(every)) == 0).distinct().collect())
    return sorted({picked[len(picked) * i // ranges] for i in range(1, ranges)}) if picked else []


def sorted_runs(entries: DataFrame, folder: str) -> DataFrame:
    """One sorted run per task of entries that are sorted within their tasks, as rows of RUN."""

    def write(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def cut() -> Iterator[pa.RecordBatch]:
            for b in it:
                for x in shared.batches_of((b.slice(i, GROUP_ROWS) for i in range(0, b.num_rows, GROUP_ROWS)), "url_key", GROUP_BYTES):
                    yield x.cast(ENTRIES)

        yield from _write_run(cut(), folder, TaskContext.get().partitionId(), 0)

    return shared.written(entries.mapInArrow(write, RUN), "runs")


def _merges(runs: DataFrame, cuts: list[tuple], ways: int) -> DataFrame:
    """(group, range_no, files): what each merge reads; files is a list of (run, part, path), bounded by ways times a run's files there."""

    def overlaps(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            rows = []
            for run, part, path, low, high in zip(*(batch.column(c).to_pylist() for c in ("run", "part", "path", "low", "high"))):
                for r in range(bisect.bisect_right(cuts, _loaded(low)), bisect.bisect_right(cuts, _loaded(high)) + 1):
                    rows.append({"group": run // ways, "range_no": r, "run": run, "part": part, "path": path})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("group", pa.int64()), ("range_no", pa.int64()), ("run", pa.int64()), ("part", pa.int64()), ("path", pa.string())]))

    found = runs.mapInArrow(overlaps, "group long, range_no long, run long, part long, path string")
    return found.groupBy("group", "range_no").agg(F.sort_array(F.collect_list(F.struct("run", "part", "path"))).alias("files"))


def _merged(files: list[dict], cuts: list[tuple], number: int) -> Iterator[tuple]:
    by_run = [[f["path"] for f in group] for _, group in itertools.groupby(files, key=lambda f: f["run"])]
    low = cuts[number - 1] if number else None
    high = cuts[number] if number < len(cuts) else None
    return iter(LoserTree([_read_run(paths, low, high) for paths in by_run]))


def merge_runs(runs: DataFrame, folder: str, ways: int = MERGE_WAYS, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The entries of sorted runs in global order: range_no, then place in the range. A URL with very many captures spans ranges.

    While there are more than `ways` runs, groups of them become longer runs, range by range; the last merge gives rows.
    """
    while True:
        size = runs.agg(F.coalesce(F.max("run") + 1, F.lit(0)).alias("runs"), F.coalesce(F.sum("entries"), F.lit(0)).alias("entries")).first()
        groups = max(1, -(-size.runs // ways))
        cuts = _cuts(runs, -(-size.entries // (groups * range_rows)))
        plan = _merges(runs, cuts, ways).repartition(groups * (len(cuts) + 1), "group", "range_no")
        if groups == 1:
            break

        def lengthen(it: Iterator[pa.RecordBatch], cuts: list[tuple] = cuts) -> Iterator[pa.RecordBatch]:
            for batch in it:
                for r in batch.to_pylist():
                    yield from _write_run(_batches(_merged(r["files"], cuts, r["range_no"])), folder, r["group"], r["range_no"])

        runs = shared.written(plan.mapInArrow(lengthen, RUN), "runs")

    def merge(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for r in batch.to_pylist():
                place = 0
                for out in _batches(_merged(r["files"], cuts, r["range_no"])):
                    n = out.num_rows
                    yield pa.RecordBatch.from_arrays([pa.array([r["range_no"]] * n, pa.int64()), pa.array(range(place, place + n), pa.int64()), *out.columns], names=["range_no", "place", *ENTRIES.names])
                    place += n

    return plan.mapInArrow(merge, "range_no long, place long, " + ENTRY)


def with_places(index: DataFrame) -> DataFrame:
    """Places counted through all ranges, from 0: a range's entries follow those of the ranges before it. One number a range is broadcast."""
    sizes = index.groupBy("range_no").agg(F.count("*").alias("n")).collect()
    before = list(itertools.accumulate((r.n for r in sorted(sizes)), initial=0))
    starts = index.sparkSession.createDataFrame([(r.range_no, b) for r, b in zip(sorted(sizes), before)], "range_no long, before long")
    return index.join(F.broadcast(starts), "range_no").withColumn("place", F.col("place") + F.col("before")).drop("before")


def read_archives(index: DataFrame, ways: int) -> DataFrame:
    """The records an index names: each file's, in order of place, by one task."""

    def read(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = source = None
        for batch in it:
            rows = []
            for file, offset, size, number, place in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "size", "range_no", "place"))):
                if file != name:
                    if source is not None:
                        source.close()
                    where, path = shared.file_system(file)
                    name, source = file, where.open_input_file(path)
                source.seek(offset)
                rows.append(parsed(source.read(size)) | {"range_no": number, "place": place})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("range_no", pa.int64()), ("place", pa.int64())]))
        if source is not None:
            source.close()

    dealt = index.repartition(ways, "file", F.shiftright("offset", 24)).sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, range_no long, place long")


def archived(pages: DataFrame) -> DataFrame:
    """Write pages (page_id, url, html) to archives, merge the index, and read every record back.

    Of records with equal payloads of at least LEAST_BYTES the one with the largest page_id is the response, the others revisit it.
    Null html is empty, a null url has the empty key and no target, a null page_id counts as the smallest; of rows that repeat the largest page_id all are responses. Other columns are ignored; an empty table gives no rows.
    """
    spark = pages.sparkSession
    entries = write_archives(with_responses(pages), shared.new_folder(spark, "warc"))
    folder = shared.new_folder(spark, "index")
    index = shared.written(merge_runs(sorted_runs(entries, folder), folder), "index")
    return read_archives(with_places(index), shared.partitions(spark))


def op3_warc(spark, sf_dir):
    """All pages archived and read back; place is a capture's number in the merged index of all captures, by URL key, time and page."""
    return archived(shared.table(spark, sf_dir, "pages")).drop("range_no")


# the URL key in SQL covers http and https URLs without user part, as the given tables hold; the others are tested in Python
ORACLE = {
    "op3_warc": """WITH page AS (
  SELECT page_id, coalesce(html, '') AS html, lower(regexp_replace(trim(coalesce(url, '')), '#.*$', '')) AS url FROM pages),
digests AS (SELECT *, octet_length(encode(html)) AS bytes, sha1(html) AS digest FROM page),
parts AS (SELECT *, regexp_replace(regexp_extract(url, '^https?://([^/?:]*)', 1), '^www\\.', '') AS host,
  regexp_extract(url, '^https?://[^/?]*([^?]*)', 1) AS path, regexp_extract(url, '([?].+)$', 1) AS query FROM digests),
keyed AS (SELECT *, CASE WHEN url = '' THEN '' ELSE array_to_string(list_reverse(string_split(host, '.')), ',') || ')'
  || CASE WHEN path = '' THEN '/' ELSE path END || query END AS url_key,
  max(page_id) OVER (PARTITION BY digest, bytes >= 1000) AS holder FROM parts)
SELECT page_id, CAST(bytes AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN bytes >= 1000 AND page_id IS DISTINCT FROM holder THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN bytes >= 1000 AND page_id IS DISTINCT FROM holder THEN holder END AS refers_to,
  row_number() OVER (ORDER BY url_key, greatest(page_id, 0) % 68719476736, page_id NULLS FIRST) - 1 AS place
FROM keyed"""
}
