"""Removal of long repeated byte strings, decided by suffix arrays of shards.

A string of ``length`` bytes belongs to the shard that its smallest k-gram hash
names, so equal strings meet in one shard and nothing else has to. Distinct
texts are cut into segments: runs of starts whose strings share that hash, with
the bytes of the last string. A hash that stands in one place of the corpus only
cannot name a repeated string; its segment goes no further. Equal segments
collapse to one with a weight. Each shard then sorts the suffixes of its segments
by ``length`` bytes, whole keys at a time: by doubled prefixes in batches of 2 MB,
and a key with more bytes by external induction with common prefixes
(``induced_sort``). Suffixes with ``length`` common bytes are one string, and a
string whose occurrences weigh two or more is repeated. No pairs are ever formed.

A hash with very many different segments (a frequent line in changing
surroundings) is too much for one shard. Its segments are cut finer: strings in
which it stands at a similar place share most of their bytes around it, and the
hash of these bytes names their shard, down to the whole string if needed.

Only segments with a repeated hash travel with their bytes; their occurrences,
and what is removed, travel as numbers.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, pick, stored
from .induced_sort import sorted_suffixes

U64 = np.uint64
GRAM = 64  # bytes of a k-gram
PLACE_BITS = 20  # places of one scan buffer, packed below the leading hash bits
MAX_STARTS = 4096  # starts of one segment; longer runs are cut
SHARD_BYTES = 12 << 20  # segment bytes a shard should hold
TASK_BUDGET = 48 << 20  # bytes of a queue or array in memory; more lies on disk
BATCH_BITS = 21  # a position, and a rank, of a batch sorted in memory
BATCH_BYTES = 1 << BATCH_BITS
# A hash is hot with more than this many different segments and more than a
# thousandth of all of them, so that there are never more than a thousand.
HOT_SEGMENTS = 2000
FINER = (24, 1)  # places that share a shard, for strings of hot hashes
MASK = U64((1 << PLACE_BITS) - 1)


def _factor(span: int) -> np.uint64:
    return U64(pow(0x9E3779B97F4A7C15, span, 1 << 64))


def rolling_hash(data: np.ndarray, span: int) -> np.ndarray:
    """Hash of the ``span`` bytes from every place on (places without as many left are cut off)."""
    power, size = (mix64(np.arange(256, dtype=U64) + U64(1)))[data], 1
    out, have = None, 0
    while True:
        if span & size:
            out = power if out is None else out[: len(out) - size] * _factor(size) + power[have : have + len(out) - size]
            have += size
        if have == span:
            return mix64(out)
        power, size = power[: max(0, len(power) - size)] * _factor(size) + power[size:], 2 * size


def _leading(h: np.ndarray, window: int) -> np.ndarray:
    """Place of the smallest hash (leftmost of equal leading bits) in every window."""
    low, size = (h & ~MASK) | np.arange(len(h), dtype=U64), 1
    while 2 * size <= window:
        low, size = np.minimum(low[:-size], low[size:]), 2 * size
    rest = window - size
    return ((np.minimum(low[: len(low) - rest], low[rest:]) if rest else low) & MASK).astype(np.int64)


def start_keys(data: np.ndarray, length: int, finer=()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every start of ``length`` bytes in ``data``: key, place that gave it, and whether it counts.

    ``finer`` holds (places, hot keys) of each refinement: only starts whose key
    was hot in every round before count, and get the finer key.
    """
    h = rolling_hash(data, GRAM)
    place = _leading(h, length - GRAM + 1)
    key, live = h[place], np.ones(len(place), bool)
    for places, hot in finer:
        live &= np.isin(key, hot)
        block = (place - np.arange(len(place))) // places
        common = rolling_hash(data, length - places + 1)
        at = np.clip(place - block * places, 0, len(common) - 1)  # in range wherever the whole string is
        key = mix64(common[at] ^ mix64(key + block.astype(U64) + U64(places)))
    return key, place, live


def _buffers(texts: list[bytes], length: int):
    """Texts laid end to end in scan buffers: (bytes, [(row, start in text, place in buffer, starts)])."""
    limit = (1 << PLACE_BITS) - 1
    parts, spans, at = [], [], 0
    for row, text in enumerate(texts):
        for a in range(0, len(text) - length + 1, limit - length):
            piece = text[a : min(len(text), a + limit - 1)]
            if at + len(piece) > limit:
                yield b"".join(parts), spans
                parts, spans, at = [], [], 0
            spans.append((row, a, at, min(limit - length, len(piece) - length + 1)))
            parts.append(piece)
            at += len(piece)
    if spans:
        yield b"".join(parts), spans


def segments(texts: list[bytes], length: int, finer=()):
    """(row, start, starts, key, several, digest) of all segments of the texts.

    ``several``: the key's hash stands in more than one place of the segment.
    """
    for data, spans in _buffers(texts, length):
        key, place, live = start_keys(np.frombuffer(data, np.uint8), length, finer)
        for row, a, at, starts in spans:
            own = key[at : at + starts]
            cuts = np.flatnonzero(own[1:] != own[:-1]) + 1
            edges = [0, *cuts.tolist(), starts]
            for b, e in zip(edges, edges[1:]):
                if not live[at + b]:
                    continue
                for x in range(b, e, MAX_STARTS):
                    y = min(e, x + MAX_STARTS)
                    digest = hashlib.blake2b(data[at + x : at + y + length - 1], digest_size=16).digest()
                    several = bool(place[at + x] != place[at + y - 1])
                    yield row, a + x, y - x, int(key[at + x].view(np.int64)), several, digest


SEGMENT = "tid binary, start int, starts int, key long, several boolean, digest binary, n long"


def _segment_rows(texts: DataFrame, length: int, finer=()) -> DataFrame:
    schema = pa.schema([("tid", pa.binary()), ("start", pa.int32()), ("starts", pa.int32()), ("key", pa.int64()),
                        ("several", pa.bool_()), ("digest", pa.binary()), ("n", pa.int64())])

    def run(batches):
        for batch in batches:
            tid, n = batch.column("tid").to_pylist(), batch.column("n").to_pylist()
            columns = list(zip(*((tid[r], a, k, key, several, digest, n[r]) for r, a, k, key, several, digest
                                 in segments(batch.column("bytes").to_pylist(), length, finer))))
            if columns:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return texts.mapInArrow(run, SEGMENT)


def _repeated_keys(rows: DataFrame) -> DataFrame:
    """Segments whose key stands in two places of the corpus, or twice in themselves."""
    keys = rows.groupBy("key").agg(F.sum("n").alias("k"), F.max("several").alias("s")).where("k > 1 OR s").select("key")
    return rows.join(keys, "key")


def repeated_starts(parts: list[bytes], weights: list[int], length: int, budget: int = TASK_BUDGET) -> list[list[list[int]]]:
    """For each segment the runs [from, to) of starts whose string of ``length`` bytes weighs two or more in all of them."""
    sizes = np.array([len(p) for p in parts], np.int64)
    ends = np.cumsum(sizes + 1)  # a separator follows each segment
    begins = ends - sizes - 1
    n = int(ends[-1]) + 1
    text = np.empty(n, np.uint16)
    joined = np.frombuffer(b"\0".join(parts), np.uint8)
    text[: n - 2] = joined
    text[: n - 2] += 2
    text[ends - 1] = 1
    text[n - 1] = 0
    weight = np.array(weights, np.int64)
    repeated = np.zeros(n, bool)
    held: list[tuple[np.ndarray, np.ndarray]] = []  # the group that a later block may continue

    def settle(pos, lcp):
        group = np.cumsum(lcp < length)
        segment = np.searchsorted(ends, pos, side="right")
        counts = (segment < len(parts)) & (pos + length < ends[np.minimum(segment, len(parts) - 1)])
        group, pos, segment = group[counts], pos[counts], segment[counts]
        if len(pos):
            total = np.bincount(group, weight[segment].astype(np.float64))
            repeated[pos[total[group] > 1]] = True

    def emit(pos, lcp, _):
        cut = np.flatnonzero(lcp < length)
        if not len(cut):
            held.append((pos, lcp))
            return
        held.append((pos[: cut[-1]], lcp[: cut[-1]]))
        settle(np.concatenate([p for p, _ in held]), np.concatenate([v for _, v in held]))
        held[:] = [(pos[cut[-1] :], lcp[cut[-1] :])]

    sorted_suffixes(text, 258, length, emit, budget)
    if held:
        settle(np.concatenate([p for p, _ in held]), np.concatenate([v for _, v in held]))
    edges = np.flatnonzero(np.diff(repeated.astype(np.int8), prepend=0, append=0))
    out: list[list[list[int]]] = [[] for _ in parts]
    for (a, b), segment in zip(edges.reshape(-1, 2).tolist(), np.searchsorted(ends, edges[::2], side="right").tolist()):
        out[segment].append([int(a - begins[segment]), int(b - begins[segment])])
    return out


def repeated_starts_in_memory(parts: list[bytes], weights: list[int], length: int) -> list[list[list[int]]]:
    """What ``repeated_starts`` gives, for segments of at most ``BATCH_BYTES`` bytes in all.

    A suffix's rank is the place of the first suffix with the same leading bytes;
    ranks by twice as many bytes come from sorting pairs of ranks, up to
    ``length``. A pair and its position fill one 64-bit number, so numbers alone
    are sorted. Suffixes that stand alone, or end before the bytes asked for,
    are done.
    """
    text = np.frombuffer(b"".join(parts), np.uint8)
    n, sizes = len(text), np.array([len(p) for p in parts], np.int64)
    ends = np.cumsum(sizes)
    left = np.repeat(ends, sizes) - np.arange(n)  # bytes to the end of the segment
    symbols, code = np.unique(text, return_inverse=True)
    bits = max(1, int(len(symbols) - 1).bit_length())
    span = min(length, 2 * BATCH_BITS // bits)
    lead = np.zeros(n - span + 1, np.int64)
    for k in range(span):
        lead = lead << bits | code[k : k + len(lead)]
    pos = np.flatnonzero(left[: len(lead)] >= span)
    pairs = lead[pos] << BATCH_BITS | pos
    low = (1 << BATCH_BITS) - 1
    rank, whole = np.zeros(n, np.int64), None  # whole: ranks by fewer bytes of the sorted suffixes
    while True:
        pairs.sort()
        pos, pair = pairs & low, pairs >> BATCH_BITS
        at = np.arange(len(pos))
        fresh = np.append(True, pair[1:] != pair[:-1])[: len(pos)]
        first = np.maximum.accumulate(np.where(fresh, at, 0))
        if whole is not None:
            major = pair >> BATCH_BITS
            opens = np.append(True, major[1:] != major[:-1])[: len(pos)]
            first_of_major = np.maximum.accumulate(np.where(opens, at, 0))
            rank[pos] = major + first - first_of_major
        else:
            rank[pos] = first
        shared = ~(fresh & np.append(fresh[1:], True)[: len(pos)])
        pos = pos[shared]
        if span == length or not len(pos):
            break
        further = min(span, length - span)
        pos = pos[left[pos] >= span + further]
        whole = rank[pos]
        pairs = whole << 2 * BATCH_BITS | rank[pos + further] << BATCH_BITS | pos
        span += further
    repeated = np.repeat(np.array(weights, np.int64) > 1, sizes)
    repeated[pos] = True
    repeated &= left >= length
    edges = np.flatnonzero(np.diff(repeated.astype(np.int8), prepend=0, append=0))
    out: list[list[list[int]]] = [[] for _ in parts]
    begins = ends - sizes
    for (a, b), segment in zip(edges.reshape(-1, 2).tolist(), np.searchsorted(ends, edges[::2], side="right").tolist()):
        out[segment].append([int(a - begins[segment]), int(b - begins[segment])])
    return out


def _runs_by_key(keys: list[int], parts: list[bytes], weights: list[int], length: int, batch_bytes: int):
    """``(index, runs)`` of all segments: equal strings share a key, so whole keys are sorted in batches.

    A key with more bytes than a batch is sorted by induction, which spills.
    """
    batch: list[int] = []
    size = 0

    def sort(some):
        few = sum(len(parts[i]) for i in some) <= batch_bytes
        method = repeated_starts_in_memory if few else repeated_starts
        return zip(some, method([parts[i] for i in some], [weights[i] for i in some], length))

    for _, group in itertools.groupby(sorted(range(len(keys)), key=keys.__getitem__), key=keys.__getitem__):
        group = list(group)
        more = sum(len(parts[i]) for i in group)
        if batch and size + more > batch_bytes:
            yield from sort(batch)
            batch, size = [], 0
        batch += group
        size += more
    if batch:
        yield from sort(batch)


RUNS = "key long, digest binary, runs array<array<int>>"


def _sorted_shards(parts: DataFrame, shards: int, length: int, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """``key, digest, runs`` of the segments that hold a repeated string."""
    def run(batches):
        keys, digests, texts, weights = [], [], [], []
        for batch in batches:
            for store, column in zip((keys, digests, texts, weights), ("key", "digest", "bytes", "n")):
                store += batch.column(column).to_pylist()
        if texts:
            found = ((i, runs) for i, runs in _runs_by_key(keys, texts, weights, length, batch_bytes) if runs)
            while some := list(itertools.islice(found, 10_000)):
                yield pa.RecordBatch.from_arrays([
                    pa.array([keys[i] for i, _ in some], pa.int64()), pa.array([digests[i] for i, _ in some], pa.binary()),
                    pa.array([runs for _, runs in some], pa.list_(pa.list_(pa.int32())))], ["key", "digest", "runs"])

    return parts.repartition(shards, "key").mapInArrow(run, RUNS)


def kept_bytes(text: bytes, starts: list[tuple[int, int]], length: int) -> tuple[int, int, str]:
    """Bytes removed, maximal removed runs, and the digest of what stays, given runs of repeated starts."""
    edge = np.zeros(len(text) + 1, np.int64)
    for a, b in starts:
        edge[a] += 1
        edge[b - 1 + length] -= 1
    gone = np.cumsum(edge[:-1]) > 0
    spans = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
    kept = np.frombuffer(text, np.uint8)[~gone]
    return int(gone.sum()), spans, hashlib.sha256(kept.tobytes()).hexdigest()


def drop_repeats(docs: DataFrame, length: int = 400, shard_bytes: int = SHARD_BYTES, hot_segments: int = HOT_SEGMENTS) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``.

    Texts are UTF-8 bytes. A byte goes when some string of ``length`` bytes over
    it also starts anywhere else in the table; strings are judged on the input.
    Matches never cross documents.

    Defined cases: a null text is empty; texts shorter than ``length`` keep all;
    repeated rows and equal texts are occurrences of each other, so they lose
    all their bytes when they are ``length`` bytes or longer; a null doc_id is
    carried as null; an empty table gives no rows. Texts of any length are read
    whole. Other columns are ignored.
    """
    rows = pick(docs, doc_id="long", text="string").select(
        "doc_id", F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("bytes"))
    whole = F.unhex(F.sha2("bytes", 256))
    texts = stored(rows.where(F.octet_length("bytes") >= length).groupBy("bytes").agg(F.count(F.lit(1)).alias("n"))
                   .select(whole.alias("tid"), "bytes", "n"), "repeat-texts")
    found = stored(_segment_rows(texts, length), "repeat-segments")
    total = found.count()
    candidates = stored(_repeated_keys(found), "repeat-candidates")
    finer: list[tuple[int, np.ndarray]] = []
    for places in FINER:
        # Keys with too many different segments: at most a thousand by the second bound.
        hot = [r.key for r in candidates.groupBy("key", "digest").agg(F.lit(1)).groupBy("key").agg(F.count(F.lit(1)).alias("k"))
               .where(F.col("k") > max(hot_segments, total // 1000)).select("key").collect()]
        if not hot:
            break
        finer.append((places, np.array(hot, np.int64).view(U64)))
        cut = candidates.where(F.col("key").isin(hot)).select("tid").distinct()
        again = _segment_rows(texts.join(cut, "tid", "left_semi"), length, tuple(finer))
        candidates = stored(candidates.where(~F.col("key").isin(hot)).unionByName(_repeated_keys(stored(again, "repeat-finer"))),
                            "repeat-candidates")
    # One carrier of each different segment lends its bytes.
    carriers = candidates.groupBy("key", "digest").agg(
        F.min(F.struct("tid", "start", "starts")).alias("at"), F.sum("n").alias("n"))
    wanted = carriers.groupBy("at.tid").agg(F.collect_list(F.struct("at.start", "at.starts", "key", "digest", "n")).alias("cuts"))
    parts = stored(
        wanted.join(texts.select("tid", "bytes"), "tid").select("bytes", F.explode("cuts").alias("c")).select(
            "c.key", "c.digest", "c.n", F.expr(f"substring(bytes, c.start + 1, c.starts + {length - 1})").alias("bytes")),
        "repeat-parts")
    size = parts.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    spark = docs.sparkSession
    shards = max(1, -(-size // shard_bytes), min(int(spark.conf.get("spark.sql.shuffle.partitions")), size >> 20))
    runs = stored(_sorted_shards(parts, int(shards), length), "repeat-runs")
    hits = candidates.select("tid", "start", "key", "digest").join(runs, ["key", "digest"]).select(
        "tid", F.explode(F.transform("runs", lambda r: F.struct((r[0] + F.col("start")).alias("a"), (r[1] + F.col("start")).alias("b")))).alias("run"))
    per_text = hits.groupBy("tid").agg(F.collect_list("run").alias("found")).join(texts.select("tid", "bytes"), "tid")

    def judge(batches):
        for batch in batches:
            out = [kept_bytes(text, [(r["a"], r["b"]) for r in found], length)
                   for text, found in zip(batch.column("bytes").to_pylist(), batch.column("found").to_pylist())]
            removed, spans, kept = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("tid"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                                              pa.array(kept, pa.string())], ["tid", "removed", "spans", "kept"])

    cut_texts = stored(per_text.select("tid", "bytes", "found").mapInArrow(judge, "tid binary, removed long, spans long, kept string"),
                       "repeat-kept")
    every = rows.select("doc_id", F.octet_length("bytes").cast("long").alias("n_bytes"), F.sha2("bytes", 256).alias("sha"))
    return every.withColumn("tid", F.unhex("sha")).join(cut_texts, "tid", "left").select(
        "doc_id", "n_bytes", F.coalesce("removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("spans", F.lit(0).cast("long")).alias("n_spans"), F.coalesce("kept", "sha").alias("kept_sha256"))
