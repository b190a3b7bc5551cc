"""Exact substring dedup over a sparse suffix array, sorted by a distributed merge that never re-compares known prefixes.

Every byte covered by a ``LENGTH``-byte string that also starts elsewhere is removed.

Which suffixes. A string of ``LENGTH`` bytes holds ``WINDOW`` grams of ``GRAM`` bytes, and wherever it occurs the grams with
its smallest hash stand at the same places. These anchors (one in some 170 bytes) are the only suffixes that need sorting:
two occurrences of the string share an anchor, agree on the bytes before it (fewer than ``WINDOW``) and from it on (at most
``LENGTH``), and both agreements together have at least ``LENGTH`` bytes. Anchors whose gram occurs once are dropped first.

Sorting. A task sorts its anchors' suffixes, front-codes them (length of the prefix shared with the one before, then the
rest) and sends a run to each bucket of gram hashes. A bucket merges its runs with a loser tree: a loser keeps the length of
the prefix it shares with the winner that beat it, a new candidate brings the length from front coding, so most matches
compare two numbers, and bytes are read from the first unknown place on only. The tree also gives the prefix that each
suffix shares with the one before.

Matching. Suffixes that share their gram form a cluster. Its members join in the order of falling shared prefixes; joined
groups are kept sorted by the bytes before the anchor, and each member of the smaller group meets its two neighbours in the
larger one: for a falling right part these are the only partners that can make the left part longer. So a cluster of n
members costs O(n log n) steps whatever they have in common, and no pairs are listed.

Copies. Equal texts are one text that occurs several times: all its bytes are covered, and it still is a source for others.

Scale. Texts move twice, to their repeated anchors and to their spans; a task sends each distinct text once. One gram's
distinct surroundings are merged in one task: some hundred bytes for each distinct text that has it, spilled by nothing, so
a gram in very many different texts needs smaller texts per task or a longer GRAM.

Edge cases: a null text is empty; texts below ``LENGTH`` bytes lose nothing; repeated rows count as copies and are each
returned; ids may be null; spans are judged on the input; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formflow.llm.batches import slices
from formflow.llm.hashing import _powers, mix
from formflow.session import materialise

LENGTH, GRAM = 400, 64
WINDOW = LENGTH - GRAM + 1
#: Anchors of a bucket on average; bytes of suffixes that a task sorts at a time.
BUCKET, RUN_BYTES = 40_000, 24 << 20
#: Bytes of texts for which anchors are worked out at a time; some 160 bytes of memory for each.
BLOCK = 1 << 18

Entry = tuple[bytes, bytes, bytes, int]  # suffix, bytes before it backwards, print of the text, place


def _sliding(x: np.ndarray, width: int, better: np.ufunc) -> np.ndarray:
    """The best of each ``width`` consecutive values, from the running bests of fixed blocks in both directions."""
    n = len(x) - width + 1
    worst = np.iinfo(x.dtype).max if better is np.minimum else np.iinfo(x.dtype).min
    blocks = np.concatenate([x, np.full(-len(x) % width, worst, dtype=x.dtype)]).reshape(-1, width)
    ahead = better.accumulate(blocks, axis=1).ravel()
    back = better.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return better(back[:n], ahead[width - 1 : width - 1 + n])


def anchors_of(raw: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of the texts between ``borders``: gram hash, number of the text, place in the text."""
    none = np.zeros(0, np.int64)
    if len(raw) < LENGTH:
        return np.zeros(0, np.uint64), none, none
    up, down = _powers(len(raw))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up, dtype=np.uint64)])
    grams = len(raw) - GRAM + 1
    # The lowest value is kept for windows that cross a border.
    value = mix((total[GRAM:] - total[:-GRAM]) * down[:grams]) | np.uint64(1)
    least = _sliding(value, WINDOW, np.minimum)
    sizes = np.diff(borders)
    ends = np.repeat(borders[1:], sizes)[: len(least)]
    least[np.arange(len(least)) + LENGTH > ends] = 0
    padded = np.concatenate([np.zeros(WINDOW - 1, np.uint64), least, np.zeros(WINDOW - 1, np.uint64)])
    at = np.flatnonzero(_sliding(padded, WINDOW, np.maximum)[:grams] == value)
    text = np.searchsorted(borders, at, side="right") - 1
    return value[at], text, at - borders[text]


def anchors_by_block(raw: np.ndarray, borders: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The anchors of the texts, as ``anchors_of`` has them, in blocks of windows; one of two blocks' windows comes twice."""
    for start in range(0, max(len(raw) - LENGTH + 1, 0), BLOCK):
        end = min(len(raw), start + BLOCK + LENGTH - 1)
        inside = np.unique(np.clip(borders, start, end))
        value, text, at = anchors_of(raw[start:end], inside - start)
        at = at + inside[text]
        text = np.searchsorted(borders, at, side="right") - 1
        yield value, text, at - borders[text]


def _raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    _, borders, data = column.buffers()
    borders = np.frombuffer(borders, dtype=np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, dtype=np.uint8)[borders[0] : borders[-1]], borders - borders[0]


def _once_a_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[bytes] = set()
    for batch in batches:
        keep = []
        for name in batch.column("print").to_pylist():
            keep.append(name not in seen)
            seen.add(name)
        yield batch.filter(pa.array(keep, pa.bool_()))


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors of the texts, each distinct text of a task once."""
    for batch in _once_a_task(batches):
        for some in slices(batch, "text"):
            for value, text, at in anchors_by_block(*_raw(some.column("text"))):
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(value.view(np.int64)), some.column("print").take(pa.array(text)), pa.array(at.astype(np.int32))], ["gram", "print", "at"])


def shared_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes are known to agree."""
    low, high = known, min(len(a), len(b))
    if a[low:high] == b[low:high]:
        return high
    step = 8
    while low + step < high and a[low : low + step] == b[low : low + step]:
        low, step = low + step, 2 * step
    high = min(high, low + step)
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def encode_run(entries: list[Entry]) -> bytes:
    """A sorted run, front-coded: suffixes by the one before, bytes before the anchor likewise."""
    numbers = np.zeros((5, len(entries)), dtype=np.int32)
    rests, prints, before = [], [], (b"", b"")
    for i, (right, left, name, at) in enumerate(entries):
        r, l = shared_prefix(right, before[0]), shared_prefix(left, before[1])
        numbers[:, i] = r, len(right), l, len(left), at
        rests += [right[r:], left[l:]]
        prints.append(name)
        before = (right, left)
    return zlib.compress(np.int64(len(entries)).tobytes() + numbers.tobytes() + b"".join(prints) + b"".join(rests), 1)


def decode_run(block: bytes) -> Iterator[tuple[Entry, int]]:
    """The entries of a run with the prefix that each shares with the one before."""
    data = zlib.decompress(block)
    n = int(np.frombuffer(data[:8], np.int64)[0])
    numbers = np.frombuffer(data, np.int32, 5 * n, 8).reshape(5, n).T.tolist()
    names, place = 8 + 20 * n, 8 + 36 * n
    right = left = b""
    for i, (r, right_len, l, left_len, at) in enumerate(numbers):
        right = right[:r] + data[place : place + right_len - r]
        place += right_len - r
        left = left[:l] + data[place : place + left_len - l]
        place += left_len - l
        yield (right, left, data[names + 16 * i : names + 16 * i + 16], at), r


def merge_runs(runs: list[Iterator[tuple[Entry, int]]]) -> Iterator[tuple[Entry, int]]:
    """All entries in the order of their suffixes, each with the prefix it shares with the one before.

    ``lcp`` of a run is the prefix that its head shares with the last entry given out. Of two heads the one that shares
    more is smaller; only if both share the same are bytes compared, from there on.
    """
    size = 1
    while size < len(runs):
        size *= 2
    heads: list[Entry | None] = [None] * size
    lcp = [0] * size
    loser = [0] * size

    def advance(k: int) -> None:
        heads[k], lcp[k] = next(runs[k], (None, 0)) if k < len(runs) else (None, 0)

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's shared prefix becomes the one with the winner."""
        x, y = heads[a], heads[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        if lcp[a] != lcp[b]:
            return (a, b) if lcp[a] > lcp[b] else (b, a)
        same = shared_prefix(x[0], y[0], lcp[a])
        if x[0][same : same + 1] <= y[0][same : same + 1]:
            lcp[b] = same
            return a, b
        lcp[a] = same
        return b, a

    for k in range(size):
        advance(k)
    winners = list(range(size))
    node = size
    while node > 1:
        node //= 2
        nexts = []
        for i in range(node):
            won, lost = play(winners[2 * i], winners[2 * i + 1])
            loser[node + i] = lost
            nexts.append(won)
        winners = nexts
    best = winners[0]
    while heads[best] is not None:
        yield heads[best], lcp[best]
        advance(best)
        node = (best + size) // 2
        while node:
            best, loser[node] = play(best, loser[node])
            node //= 2


def cluster_extents(entries: list[Entry], shared: list[int], length: int = LENGTH) -> list[tuple[int, int]]:
    """Per entry of a cluster how far before and after its anchor repeated strings of ``length`` bytes reach; (0, 0): none.

    ``shared[i]`` is the prefix that entry i shares with entry i - 1.
    """
    n = len(entries)
    best = [(0, 0)] * n
    if n == 2:
        l, r = shared_prefix(entries[0][1], entries[1][1]), shared[1]
        return [(l, r)] * 2 if l + r >= length else best
    group = list(range(n))
    members: list[list[tuple[bytes, int]] | None] = [[(e[1], i)] for i, e in enumerate(entries)]

    def root(i: int) -> int:
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    def widen(i: int, l: int, r: int) -> None:
        if best[i][0] < l or best[i][1] < r:
            best[i] = (max(best[i][0], l), max(best[i][1], r))

    for k in sorted(range(1, n), key=lambda i: -shared[i]):
        r, a, b = shared[k], root(k - 1), root(k)
        small, large = (members[a], members[b]) if len(members[a]) < len(members[b]) else (members[b], members[a])
        for left, i in small:
            at = bisect_left(large, (left, i))
            for near in (at - 1, at):
                if 0 <= near < len(large):
                    l = shared_prefix(left, large[near][0])
                    if l + r >= length:
                        widen(i, l, r)
                        widen(large[near][1], l, r)
            large.insert(at, (left, i))
        group[a] = b
        members[a], members[b] = None, large
    return best


class Cluster:
    """Entries that share a gram, taken in sorted order: equal surroundings are one member from the start.

    ``shared[i]`` is the prefix that member i shares with member i - 1; ``owners[i]`` are its places.
    """

    def __init__(self) -> None:
        self.members: list[Entry] = []
        self.shared: list[int] = []
        self.owners: list[set[tuple[bytes, int]]] = []
        self._number: dict[tuple[bytes, bytes], int] = {}
        self._since = LENGTH

    def add(self, entry: Entry, shared: int) -> None:
        self._since = min(self._since, shared)
        k = self._number.setdefault(entry[:2], len(self.members))
        if k == len(self.members):
            self.members.append(entry)
            self.shared.append(self._since)
            self.owners.append(set())
            self._since = LENGTH
        self.owners[k].add(entry[2:])


def _runs(buckets: int):
    def flush(entries: dict[int, list[Entry]]) -> pa.RecordBatch:
        blocks = [(b, encode_run(sorted(e))) for b, e in entries.items()]
        return pa.RecordBatch.from_arrays([pa.array([b for b, _ in blocks], pa.int32()), pa.array([x for _, x in blocks], pa.binary())], ["bucket", "run"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries: dict[int, list[Entry]] = {}
        held, seen = 0, set()
        for batch in batches:
            for i in range(batch.num_rows):
                name = batch.column("print")[i].as_py()
                if name in seen:
                    continue
                seen.add(name)
                text = batch.column("text")[i].as_py()
                for a in batch.column("anchors")[i].as_py():
                    at = a["at"]
                    left = text[max(0, at - WINDOW + 1) : at][::-1]
                    entries.setdefault((a["gram"] >> 20) % buckets, []).append((text[at : at + LENGTH], left, name, at))
                    held += 900
                if held > RUN_BYTES:
                    yield flush(entries)
                    entries, held = {}, 0
        if entries:
            yield flush(entries)

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names: list[bytes] = []
    starts: list[int] = []
    ends: list[int] = []

    def out() -> pa.RecordBatch:
        rows = pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], ["print", "start", "end"])
        names.clear(), starts.clear(), ends.clear()
        return rows

    def settle(cluster: Cluster) -> None:
        """Equal surroundings of different places are covered as far as they reach."""
        for (right, left, _, _), own, (l, r) in zip(cluster.members, cluster.owners, cluster_extents(cluster.members, cluster.shared)):
            if len(own) > 1 and len(left) + len(right) >= LENGTH:
                l, r = len(left), len(right)
            if r:
                for name, at in own:
                    names.append(name)
                    starts.append(at - l)
                    ends.append(at + r)

    def bucket(blocks: list[bytes]) -> Iterator[pa.RecordBatch]:
        cluster = Cluster()
        for entry, r in merge_runs([decode_run(b) for b in blocks]):
            if r < GRAM and cluster.members:
                settle(cluster)
                cluster = Cluster()
                if len(names) > 100_000:
                    yield out()
            cluster.add(entry, r)
        if cluster.members:
            settle(cluster)

    now, blocks = None, []
    for batch in batches:
        for b, block in zip(batch.column("bucket").to_pylist(), batch.column("run").to_pylist()):
            if b != now and blocks:
                yield from bucket(blocks)
                blocks = []
            now = b
            blocks.append(block)
    if blocks:
        yield from bucket(blocks)
    if names:
        yield out()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    done: set[bytes] = set()
    for batch in batches:
        rows = []
        for i in range(batch.num_rows):
            name = batch.column("print")[i].as_py()
            if name in done:
                continue
            done.add(name)
            text, removed, place, digest = batch.column("text")[i].as_py(), [], 0, hashlib.sha256()
            for s in sorted((s["start"], s["end"]) for s in batch.column("spans")[i].as_py()):
                if removed and s[0] <= removed[-1][1]:
                    removed[-1][1] = max(removed[-1][1], s[1])
                else:
                    removed.append([*s])
            for start, end in removed:
                digest.update(text[place:start])
                place = end
            digest.update(text[place:])
            rows.append((name, [{"start": a, "end": b} for a, b in removed], digest.hexdigest()))
        if rows:
            span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], span), pa.array([r[2] for r in rows])],
                                             ["print", "removed", "kept_sha256"])


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, ``removed`` (disjoint byte spans, sorted) and ``kept_sha256`` of the other bytes."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    named = docs.select("doc_id", text.alias("text")).withColumn("sha", F.sha2("text", 256))
    named = named.withColumn("print", F.unhex(F.substring("sha", 1, 32)))
    rows = materialise(named.select("doc_id", "sha", "print", F.octet_length("text").cast("long").alias("n_bytes")), "suffix-rows")
    long_enough = named.where(F.octet_length("text") >= LENGTH).select("print", "text")
    texts = long_enough.mapInArrow(_once_a_task, "print binary, text binary")
    anchors = materialise(long_enough.mapInArrow(_anchored, "gram long, print binary, at int"), "suffix-anchors")
    place = F.struct("print", "at")
    repeated = materialise(anchors.groupBy("gram").agg(F.min(place).alias("lo"), F.max(place).alias("hi")).where("lo <> hi").select("gram"), "suffix-grams")
    flagged = materialise(anchors.join(repeated, "gram").groupBy("print").agg(F.collect_set(F.struct("gram", "at")).alias("anchors")), "suffix-flagged")
    n = flagged.agg(F.sum(F.size("anchors"))).first()[0] or 0
    buckets = int(n // BUCKET + 12)
    runs = texts.join(flagged, "print").mapInArrow(_runs(buckets), "bucket int, run binary")
    spans = runs.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_merged, "print binary, start int, end int")
    spans = materialise(spans.groupBy("print").agg(F.collect_set(F.struct("start", "end")).alias("spans")), "suffix-spans")
    cut = texts.join(spans, "print").mapInArrow(_cut, "print binary, removed array<struct<start:int,end:int>>, kept_sha256 string")
    cut = materialise(cut.dropDuplicates(["print"]).withColumnRenamed("print", "__print"), "suffix-cut")
    copies = rows.where(F.col("n_bytes") >= LENGTH).groupBy("print").agg((F.count("*") > 1).alias("copied")).where("copied")
    copies = materialise(copies.select(F.col("print").alias("__copied")), "suffix-copies")
    joined = rows.join(cut, F.col("print") == F.col("__print"), "left").join(copies, F.col("print") == F.col("__copied"), "left")
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_bytes").cast("int").alias("end")))
    copied, nothing = F.col("__copied").isNotNull(), F.array().cast("array<struct<start:int,end:int>>")
    return joined.select(
        "doc_id", "n_bytes", F.when(copied, whole).otherwise(F.coalesce("removed", nothing)).alias("removed"),
        F.when(copied, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"))
