"""Alignment of two tokenizers' tokens over the same bytes, and corpus-wide counts of aligned id pairs.

Both tokenizers encode a text to tokens that cover its bytes (a space, then the text). Where a token of A and one of B end at
the same byte the text is cut; what lies between two cuts is a group. An A and a B token are linked if their bytes overlap.

Fragments. A byte range of a document gives a ``Fragment``: an open prefix (tokens up to the range's first cut), closed groups,
and an open suffix (tokens after its last cut); a range without a cut is one open run. A range owns the tokens that *end* inside
it, so ranges may begin anywhere, inside a word or a character. ``compose`` joins neighbours: suffix and prefix meet in one
closed group at the seam. It is associative and ``EMPTY`` is its identity, so ranges may be combined in any tree.

On Spark:

1. A text shorter than a range is a range by itself. Longer ones are cut into byte ranges, one row each, that are dealt to all
   tasks. A range carries the whole segments that it touches, so that it can encode them.
2. Tree reduction: per level, up to ``FAN_IN`` neighbouring fragments of a document are composed in one task, of which only the
   open ends travel; closed groups stay where they were found, and each seam gives one more closed group.
3. Counting: closed groups are kept in blocks with a dictionary of their distinct id pairs. The pairs are summed over all
   blocks, the highest count per B id is joined, and every block gets its own dictionary back with counts.

Encoding. A *segment* starts at a space or line feed after a character that is no white space. Neither tokenizer joins bytes
across such a place (A splits there; B has no piece with its space sign behind another character, nor one with a line feed,
which is checked on loading), so segments are encoded alone, and each distinct one once per worker.

Edge cases: a text that is null, empty or not reproduced by both tokenizers (B cannot tell U+2581 from a space) has no tokens:
zeros and an empty digest; it adds nothing to the counts. Repeated rows count as often as they occur and get equal results; ids
may be null; ties for the highest count are all best; an empty table gives no rows; further columns are ignored. Very long texts
are spread over tasks; a segment of over ``LONG_SEGMENT`` bytes (no space in it) is encoded in one piece, and one group is one
row however long it is.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formflow.llm.batches import slices
from formflow.session import materialise

RANGE, FAN_IN, LONG_SEGMENT = 1 << 16, 8, 1 << 12
#: Bytes of text of a block, and of one step within it; segments that a worker keeps.
BLOCK, STEP, KEPT_SEGMENTS = 4 << 20, 1 << 20, 250_000
#: Segments encoded at a time; an encoded one takes kilobytes until its numbers are taken.
LEARNT = 4_000
SEGMENT = re.compile(r"[ \n]\s*\S*(?:[^\S \n]\s*\S*)*")

Ids = tuple[int, ...]


@dataclass(frozen=True)
class Fragment:
    """Tokens of a byte range. ``cut``: both tokenizers end a token somewhere in it; if not, all tokens are in the prefix.

    ``closed`` holds the groups between the first and the last cut, each a pair (A ids, B ids).
    """

    prefix: tuple[Ids, Ids] = ((), ())
    closed: tuple[tuple[Ids, Ids], ...] = ()
    suffix: tuple[Ids, Ids] = ((), ())
    cut: bool = False


EMPTY = Fragment()


def _both(x: tuple[Ids, Ids], y: tuple[Ids, Ids]) -> tuple[Ids, Ids]:
    return x[0] + y[0], x[1] + y[1]


def compose(left: Fragment, right: Fragment) -> Fragment:
    """The fragment of two neighbouring byte ranges."""
    if not left.cut:
        return Fragment(_both(left.prefix, right.prefix), right.closed, right.suffix, right.cut)
    if not right.cut:
        return Fragment(left.prefix, left.closed, _both(left.suffix, right.prefix), True)
    seam = _both(left.suffix, right.prefix)
    return Fragment(left.prefix, left.closed + ((seam,) if seam != ((), ()) else ()) + right.closed, right.suffix, True)


def fragment(a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray, start: int, end: int) -> tuple[np.ndarray, ...]:
    """Bounds within the tokens for the range (start, end]: first own, first closed, first of the suffix, first beyond, for A
    then for B, and whether there is a cut. A document's start counts as a cut."""
    bounds = [np.searchsorted(ends, [start, end], side="right") for ends in (a_ends, b_ends)]
    (a0, a1), (b0, b1) = bounds
    cuts = np.intersect1d(a_ends[a0:a1], b_ends[b0:b1], assume_unique=True)
    if start == 0:
        cuts = np.r_[0, cuts]
    if not len(cuts):
        return a0, a1, a1, a1, b0, b1, b1, b1, False
    mid = [np.searchsorted(ends, [cuts[0], cuts[-1]], side="right") for ends in (a_ends, b_ends)]
    return a0, *mid[0], a1, b0, *mid[1], b1, True


def _flat(lists: list) -> tuple[np.ndarray, np.ndarray]:
    """The items of all lists, and the lists' lengths."""
    n = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(n.sum())), n


def _per_list(ids: list[list[int]], size: np.ndarray) -> np.ndarray:
    """Sum of the tokens' sizes in each list."""
    flat, n = _flat(ids)
    return np.diff(np.r_[0, np.cumsum(size[flat])][np.r_[0, np.cumsum(n)]])


# --- the two tokenizers ---------------------------------------------------------------------------------------------------


def _byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 for itself, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [x for x in range(256) if x not in set(plain)]
    return {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(rest)}


class Pair:
    """Both tokenizers, their tokens' bytes, and what is known of the segments met so far."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        if (json.loads(self.a.to_str())["pre_tokenizer"] or {}).get("type") != "ByteLevel":
            raise ValueError("tokenizer A must be byte-level")
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("\n" in p or re.search("[^▁]▁", p) for p in pieces):
            raise ValueError("tokenizer B has pieces that reach beyond a segment")
        alphabet = _byte_alphabet()
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        special = {i for i, t in self.a.get_added_tokens_decoder().items()}
        self.a_bytes = [t.encode() if i in special else bytes(alphabet[c] for c in t) for i, t in enumerate(names)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.space = self.b.piece_to_id("▁")
        self.a_size, self.b_size = (np.array([len(x) for x in t], dtype=np.int64) for t in (self.a_bytes, self.b_bytes))
        name = lambda n, sign: np.array([f"{i}{sign}".encode() for i in range(n)], dtype=object)
        self.written = {s: name(n, s) for n, s in ((len(names), ","), (len(names), "|"))}, {s: name(n, s) for n, s in ((len(pieces), ","), (len(pieces), ";"))}
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.text: list[bytes] = []
        self.n_a, self.n_b, self.n_groups = array("i"), array("i"), array("i")
        self.a_ids, self.b_ids, self.pairs = array("i"), array("i"), array("q")
        self.a_at, self.b_at, self.pairs_at, self.ok = array("q", [0]), array("q", [0]), array("q", [0]), bytearray()

    def encode(self, segments: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of single segments as they are inside a text."""
        a = [e.ids for e in self.a.encode_batch_fast(segments, add_special_tokens=False)]
        b = self.b.encode([s[1:] if s[0] == " " else s for s in segments], num_threads=1)
        for i, s in enumerate(segments):
            if s == " ":
                b[i] = [self.space]
            elif s[0] == "\n":  # B's own space in front
                b[i] = b[i][1:] if b[i][0] == self.space else [0]
        return a, b

    def learn(self, segments: list[str]) -> None:
        """Encode segments not met before and keep what they give."""
        a, b = self.encode(segments)
        raw = [s.encode() for s in segments]
        whole, sizes = b"".join(raw), np.fromiter(map(len, raw), np.int64, len(raw))
        sides = ((a, self.a_bytes, self.a_size), (b, self.b_bytes, self.b_size))
        easy = all(b"".join(map(names.__getitem__, chain.from_iterable(ids))) == whole and (_per_list(ids, size) == sizes).all() for ids, names, size in sides)
        good = [True] * len(raw)
        if not easy:
            good = [all(b"".join([names[i] for i in ids[k]]) == text for ids, names, _ in sides) for k, text in enumerate(raw)]
            a, b = ([x if g else [] for x, g in zip(ids, good)] for ids in (a, b))
        (fa, n_a), (fb, n_b) = _flat(a), _flat(b)
        done = self.closed(fa, n_a, fb, n_b)
        self.known.update(zip(segments, range(len(self.known), len(self.known) + len(segments))))
        self.text += done["text"]
        self.ok += bytes(good)
        for ids, n, kept, at, number in ((fa, n_a, self.a_ids, self.a_at, self.n_a), (fb, n_b, self.b_ids, self.b_at, self.n_b)):
            kept.frombytes(ids.astype(np.int32).tobytes())
            at.frombytes((at[-1] + np.cumsum(n)).tobytes())
            number.frombytes(n.astype(np.int32).tobytes())
        self.n_groups.frombytes(done["n_groups"].astype(np.int32).tobytes())
        self.pairs.frombytes(done["pairs"].tobytes())
        self.pairs_at.frombytes((done["pairs_at"][1:] + self.pairs_at[-1]).tobytes())

    def closed(self, fa: np.ndarray, n_a: np.ndarray, fb: np.ndarray, n_b: np.ndarray) -> dict:
        """For runs of whole groups (ids of A and of B, run after run, and the runs' lengths; equal bytes): number of groups,
        their text, their id pairs."""
        if not len(fa):
            zeros = np.zeros(len(n_a), np.int64)
            return {"n_groups": zeros, "text": [b""] * len(n_a), "pairs": np.zeros(0, np.int64), "pairs_at": np.zeros(len(n_a) + 1, np.int64)}
        a_ends, b_ends = np.cumsum(self.a_size[fa]), np.cumsum(self.b_size[fb])
        ends = np.union1d(a_ends, b_ends)
        ia, ib = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
        cut = (a_ends[ia] == ends) & (b_ends[ib] == ends)
        cuts = ends[cut]
        last_token = np.cumsum(n_a)
        run_end = np.r_[0, a_ends][last_token]
        pairs_at = np.r_[0, np.searchsorted(ends, run_end, side="right")]
        groups_at = np.r_[0, np.searchsorted(cuts, run_end, side="right")]
        ga, gb = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
        a_last, b_last = np.r_[ga[1:] != ga[:-1], True], np.r_[gb[1:] != gb[:-1], True]
        (a_words, b_words) = self.written
        words = np.concatenate([np.where(a_last, a_words["|"][fa], a_words[","][fa]), np.where(b_last, b_words[";"][fb], b_words[","][fb])])
        words = words[np.argsort(np.concatenate([2 * ga, 2 * gb + 1]), kind="stable")].tolist()
        tokens_at = np.r_[0, last_token + np.cumsum(n_b)].tolist()
        text = [b"".join(words[x:y])[:-1] for x, y in zip(tokens_at, tokens_at[1:])]
        return {"n_groups": np.diff(groups_at), "text": text, "pairs": fa[ia] << 32 | fb[ib], "pairs_at": pairs_at}

    def lookup(self, segments: list[str]) -> np.ndarray:
        new = list(dict.fromkeys(s for s in segments if s not in self.known))
        for at in range(0, len(new), LEARNT):
            self.learn(new[at : at + LEARNT])
        return np.fromiter(map(self.known.__getitem__, segments), np.int64, len(segments))


@lru_cache(maxsize=1)
def pair_of(a_path: str, b_path: str) -> Pair:
    return Pair(a_path, b_path)


# --- blocks ---------------------------------------------------------------------------------------------------------------

_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _block_schema(key_type: str) -> str:
    numbers = ", ".join(f"{c} array<long>" for c in _COUNTS)
    return (f"block long, doc_id array<{key_type}>, doc_key array<long>, {numbers}, groups_sha256 array<string>, "
            "unit_at binary, units binary, pair_at binary, unit_pairs binary, pairs array<long>, times array<long>")


def _block(number: int, doc_id: pa.Array, keys, counts: dict, digests: list[str | None], unit_at, units, pair_at, pairs) -> pa.RecordBatch:
    """One row: documents, their units (positions in the block's unit list), and the units' id pairs (positions in the dictionary).

    The positions are compressed: a row is several MB, and Spark holds it in several copies while it is moved.
    """
    distinct, code = np.unique(pairs, return_inverse=True)
    used = np.bincount(units, minlength=len(pair_at) - 1)
    times = np.bincount(code, weights=np.repeat(used, np.diff(pair_at)), minlength=len(distinct)).astype(np.int64)
    one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
    raw = lambda x, kind: pa.array([zlib.compress(np.ascontiguousarray(x, dtype=kind).tobytes(), 1)], pa.binary())
    columns = {"block": pa.array([number], pa.int64()), "doc_id": one(doc_id), "doc_key": one(pa.array(keys, pa.int64())),
               **{c: one(pa.array(np.asarray(counts[c], dtype=np.int64))) for c in _COUNTS}, "groups_sha256": one(pa.array(digests, pa.string())),
               "unit_at": raw(unit_at, "<i8"), "units": raw(units, "<i4"), "pair_at": raw(pair_at, "<i8"), "unit_pairs": raw(code, "<i4"),
               "pairs": one(pa.array(distinct)), "times": one(pa.array(times))}
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _taken(at: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the items of the chosen lists, one list after the other, and the new borders."""
    size = at[which + 1] - at[which]
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(at[which] - (ends - size), size), np.r_[0, ends]


class _Blocks:
    """Numbers of this task's blocks."""

    def __init__(self):
        from pyspark import TaskContext

        self.next = TaskContext.get().partitionId() << 24

    def number(self) -> int:
        self.next += 1
        return self.next


def _short_blocks(a_path: str, b_path: str):
    """Documents of one range: a document's fragment is closed from end to end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, blocks = pair_of(a_path, b_path), _Blocks()
        ids, parts, counts, digests, held = [], [], {c: [] for c in _COUNTS}, [], 0

        def done() -> pa.RecordBatch:
            sizes = np.array([len(x) for x in parts], dtype=np.int64)
            segments = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            own, units = np.unique(segments, return_inverse=True)
            at, pair_at = _taken(np.frombuffer(pair.pairs_at, dtype=np.int64), own)
            pairs = np.frombuffer(pair.pairs, dtype=np.int64)[at] if len(at) else np.zeros(0, np.int64)
            numbers = {c: np.concatenate([np.zeros(0, np.int64), *counts[c]]) for c in _COUNTS}
            row = _block(blocks.number(), pa.concat_arrays(ids), [None] * len(parts), numbers, digests, np.r_[0, np.cumsum(sizes)], units, pair_at, pairs)
            for x in (ids, parts, digests, *counts.values()):
                x.clear()
            if len(pair.known) > KEPT_SEGMENTS:
                pair.forget()
            return row

        for whole in batches:
            for batch in slices(whole, "text", STEP):
                texts = batch.column("text").to_pylist()
                found = [SEGMENT.findall(" " + t) if t else [] for t in texts]
                flat = pair.lookup([s for x in found for s in x])
                sizes = np.array([len(x) for x in found], dtype=np.int64)
                ends = np.cumsum(sizes)
                bad = np.frombuffer(bytes(pair.ok), dtype=np.uint8)[flat] == 0 if len(flat) else np.zeros(0, bool)
                if bad.any():
                    broken = np.add.reduceat(np.r_[bad, False].astype(np.int64), (ends - sizes)) * (sizes > 0) > 0
                    flat = flat[~np.repeat(broken, sizes)]
                    sizes = np.where(broken, 0, sizes)
                    ends = np.cumsum(sizes)
                links = np.diff(np.frombuffer(pair.pairs_at, dtype=np.int64))
                for name, per in (("n_a", pair.n_a), ("n_b", pair.n_b), ("n_groups", pair.n_groups), ("n_links", links)):
                    per = np.frombuffer(per, dtype=np.int32) if isinstance(per, array) else per
                    sums = np.r_[0, np.cumsum((per[flat] if len(flat) else np.zeros(0)).astype(np.int64))]
                    counts[name].append(sums[ends] - sums[ends - sizes])
                listed, words = flat.tolist(), pair.text
                for a, b in zip((ends - sizes).tolist(), ends.tolist()):
                    digests.append(hashlib.sha256(b";".join([words[i] for i in listed[a:b]])).hexdigest() if b > a else "")
                    parts.append(flat[a:b])
                ids.append(batch.column("doc_id"))
                held += sum(map(len, filter(None, texts)))
                if held >= BLOCK or len(pair.known) > KEPT_SEGMENTS:
                    held = 0
                    yield done()
        if parts:
            yield done()
        pair.forget()  # the worker stays, idle, while later stages move the blocks

    return run


# --- very long documents --------------------------------------------------------------------------------------------------


def byte_ranges(text: str, size: int = RANGE, long_segment: int = LONG_SEGMENT) -> Iterator[tuple[int, int, int, str]]:
    """Ranges of about ``size`` bytes of a space and the text: start, end, the byte at which their segments begin, the segments.

    A border stands at a multiple of ``size``, wherever that falls, but not inside a segment of over ``long_segment`` bytes,
    which would be encoded on both sides: there it moves to the segment's start.
    """
    start, held, at, here = 0, [], 0, 0  # of the open range: its start, segments, their first byte; bytes read so far
    goal = size
    for match in SEGMENT.finditer(" " + text):
        segment = match[0]
        length = len(segment.encode())
        if here + length > goal and length > long_segment and here > start:
            yield start, here, at, "".join(held)
            start, held, at = here, [], here
            goal = max(goal, (here // size + 1) * size)
        held.append(segment)
        here += length
        while here >= goal and length <= long_segment:
            yield start, goal, at, "".join(held)
            start = goal
            held, at = ([segment], here - length) if here > goal else ([], here)
            goal += size
        if length > long_segment:
            goal = max(goal, (here // size + 1) * size)
    if here > start:
        yield start, here, at, "".join(held)


def _cut_up(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (key, text) in enumerate(zip(batch.column("doc_key").to_pylist(), batch.column("text").to_pylist())):
                for k, (start, end, at, part) in enumerate(byte_ranges(text, size)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key], pa.int64()), batch.column("doc_id").slice(i, 1), *(pa.array([x], pa.int64()) for x in (k, start, end, at)), pa.array([part])],
                        ["doc_key", "doc_id", "k", "start", "end", "at", "text"])

    return run


#: A row of the reduction. seam 0: the open ends of a fragment; 1: a closed run of groups (A ids, B ids in ``prefix``).
_PIECE = "doc_key long, k long, side int, closed boolean, cut boolean, ok boolean, pa array<int>, pb array<int>, sa array<int>, sb array<int>"
_PIECE_NAMES = [x.split()[0] for x in _PIECE.split(", ")]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.bool_(), *[pa.list_(pa.int32())] * 4]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], _PIECE_NAMES)


def _fragments(a_path: str, b_path: str):
    """Of each range, a row with its open ends and, if it has one, a row with its closed run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, none = pair_of(a_path, b_path), []
        for batch in batches:
            for r in batch.to_pylist():
                if len(pair.known) > KEPT_SEGMENTS:
                    pair.forget()
                own = pair.lookup(SEGMENT.findall(r["text"]))
                if not all(pair.ok[i] for i in own):
                    yield _rows([(r["doc_key"], r["k"], 1, False, False, False, none, none, none, none)])
                    continue
                take = lambda ids, at: np.frombuffer(ids, dtype=np.int32)[_taken(np.frombuffer(at, dtype=np.int64), own)[0]]
                a, b = take(pair.a_ids, pair.a_at), take(pair.b_ids, pair.b_at)
                a0, a1, a2, a3, b0, b1, b2, b3, cut = fragment(
                    a, r["at"] + np.cumsum(pair.a_size[a]), b, r["at"] + np.cumsum(pair.b_size[b]), r["start"], r["end"])
                out = [(r["doc_key"], r["k"], 1, False, bool(cut), True, a[a0:a1], b[b0:b1], a[a2:a3], b[b2:b3])]
                if a2 > a1:
                    out.append((r["doc_key"], r["k"], 1, True, True, True, a[a1:a2], b[b1:b2], none, none))
                yield _rows(out)

    return run


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring fragments, sorted by document, parent and place, composed per parent. A seam's group takes its place before
    the range in which it ends (side 0 comes before side 1)."""
    at, held, ok, seams = None, EMPTY, True, []

    def done() -> pa.RecordBatch:
        return _rows([(at[0], at[1], 1, False, held.cut, ok, *held.prefix, *held.suffix), *((at[0], k, 0, True, True, True, *g, [], []) for k, g in seams)])

    for batch in batches:
        for r in batch.to_pylist():
            if at != (r["doc_key"], r["parent"]):
                if at is not None:
                    yield done()
                at, held, ok, seams = (r["doc_key"], r["parent"]), EMPTY, True, []
            right = Fragment((tuple(r["pa"]), tuple(r["pb"])), (), (tuple(r["sa"]), tuple(r["sb"])), r["cut"])
            held, ok = compose(held, right), ok and r["ok"]
            seams += [(r["first"], g) for g in held.closed]
            held = Fragment(held.prefix, (), held.suffix, held.cut)
    if at is not None:
        yield done()


def _reduced(fragments: DataFrame, ranges: int) -> tuple[DataFrame, DataFrame]:
    """Roots (one fragment per document) and all closed runs. ``ranges``: the most ranges that a document has."""
    open_ends, closed, width = fragments.where("not closed"), [fragments.where("closed")], 1
    while width < ranges:
        # k numbers the nodes of this level; the first range below a node is k * width.
        level = open_ends.withColumns({"parent": F.floor(F.col("k") / FAN_IN), "first": F.col("k") * width})
        dealt = level.repartition("doc_key", "parent").sortWithinPartitions("doc_key", "parent", "k")
        done = materialise(dealt.mapInArrow(_composed, _PIECE), "alignment-level")
        open_ends, width = done.where("not closed"), width * FAN_IN
        closed.append(done.where("closed"))
    return open_ends, reduce(DataFrame.unionByName, closed)


def _long_blocks(a_path: str, b_path: str):
    """Closed runs of long documents, each a unit of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, blocks = pair_of(a_path, b_path), _Blocks()
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                a, b = part.column("pa").to_pylist(), part.column("pb").to_pylist()
                done = pair.closed(*_flat(a), *_flat(b))
                counts = {"n_a": list(map(len, a)), "n_b": list(map(len, b)), "n_groups": done["n_groups"], "n_links": np.diff(done["pairs_at"])}
                yield _block(blocks.number(), part.column("doc_id"), part.column("doc_key").to_pylist(), counts, [None] * len(a),
                             np.arange(len(a) + 1), np.arange(len(a)), done["pairs_at"], done["pairs"])

    return run


def _digested(a_path: str, b_path: str):
    """SHA-256 of each document's groups, fed run by run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, at, digest = pair_of(a_path, b_path), None, None
        row = lambda: pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([digest.hexdigest()])], ["doc_key", "groups_sha256"])
        for batch in batches:
            for r in batch.to_pylist():
                if r["doc_key"] != at:
                    if at is not None:
                        yield row()
                    at, digest = r["doc_key"], hashlib.sha256()
                else:
                    digest.update(b";")
                digest.update(pair.closed(*_flat([r["pa"]]), *_flat([r["pb"]]))["text"][0])
        if at is not None:
            yield row()

    return run


# --- counting and scores --------------------------------------------------------------------------------------------------


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, n, best) for every linked id pair; ``pair`` is A's id times 2^32 plus B's, ``best``: no A id has more links with its B id."""
    each = blocks.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(F.col("p.pairs").alias("pair"), F.col("p.times").alias("n"))
    counts = materialise(each.groupBy("pair").agg(F.sum("n").alias("n")), "alignment-counts")
    b_id = F.col("pair").bitwiseAND((1 << 32) - 1)
    top = counts.groupBy(b_id.alias("b")).agg(F.max("n").alias("top"))
    return counts.join(top, b_id == F.col("b")).select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            cell = lambda c: batch.column(c)[i].values if batch.column(c)[i].values is not None else []
            raw = lambda c, kind: np.frombuffer(zlib.decompress(batch.column(c)[i].as_py()), dtype=kind)
            unit_at, units, pair_at, codes = raw("unit_at", "<i8"), raw("units", "<i4"), raw("pair_at", "<i8"), raw("unit_pairs", "<i4")
            out = {c: cell(c) for c in ("doc_id", "doc_key", *_COUNTS, "groups_sha256")}
            for name, column in (("n_best", "best"), ("count_sum", "n")):
                value = np.asarray(cell(column)).astype(np.int64) if len(codes) else np.zeros(0, np.int64)
                per_unit = np.diff(np.r_[0, np.cumsum(value[codes])][pair_at])
                out[name] = pa.array(np.diff(np.r_[0, np.cumsum(per_unit[units])][unit_at]))
            yield pa.RecordBatch.from_arrays(list(out.values()), list(out))


def _with_scores(blocks: DataFrame, key_type: str) -> DataFrame:
    """One row per document of a block, with the corpus-wide counts of its links."""
    each = blocks.select("block", F.posexplode("pairs").alias("at", "pair"))
    counted = each.join(pair_counts(blocks), "pair").groupBy("block").agg(F.array_sort(F.collect_list(F.struct("at", "n", "best"))).alias("d"))
    dictionary = counted.select("block", F.col("d.n").alias("n"), F.col("d.best").alias("best"))
    rest = blocks.drop("pairs", "times").join(dictionary, "block", "left").drop("block")
    numbers = ", ".join(f"{c} long" for c in _COUNTS)
    return rest.mapInArrow(_scored, f"doc_id {key_type}, doc_key long, {numbers}, groups_sha256 string, n_best long, count_sum long")


def align(docs: DataFrame, a_path: str, b_path: str, range_bytes: int = RANGE) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``a_path``: a byte-level tokenizer file; ``b_path``: a piece model that puts a space in front of a text.
    """
    key_type = docs.schema["doc_id"].dataType.simpleString()
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    is_long = F.coalesce(F.octet_length("text") >= range_bytes, F.lit(False))
    schema = _block_schema(key_type)
    short = materialise(source.where(~is_long).mapInArrow(_short_blocks(a_path, b_path), schema), "alignment-short")

    ranges = source.where(is_long).withColumn("doc_key", F.monotonically_increasing_id()).mapInArrow(
        _cut_up(range_bytes), f"doc_key long, doc_id {key_type}, k long, start long, end long, at long, text string")
    ranges = materialise(ranges, "alignment-ranges")
    own = materialise(ranges.groupBy("doc_key").agg(F.first("doc_id").alias("doc_id"), F.max("k").alias("k")), "alignment-long")
    most = own.agg(F.max("k")).first()[0]
    if most is None:
        blocks, roots, digests = short, None, None
    else:
        # Ranges are dealt to all tasks, however few files or rows the long documents came from.
        dealt = ranges.repartition(F.col("doc_key"), F.col("k")).select("doc_key", "k", "start", "end", "at", "text")
        fragments = materialise(dealt.mapInArrow(_fragments(a_path, b_path), _PIECE), "alignment-fragments")
        open_ends, closed = _reduced(fragments, most + 1)
        roots = own.drop("k").join(open_ends.select("doc_key", "ok"), "doc_key")
        whole = closed.select("doc_key", "k", "side", "pa", "pb").join(roots.where("ok").drop("ok"), "doc_key")
        runs = materialise(whole, "alignment-runs")
        blocks = short.unionByName(materialise(runs.mapInArrow(_long_blocks(a_path, b_path), schema), "alignment-long-blocks").withColumn("block", -F.col("block")))
        in_order = runs.select("doc_key", "k", "side", "pa", "pb").repartition("doc_key").sortWithinPartitions("doc_key", "k", "side")
        digests = in_order.mapInArrow(_digested(a_path, b_path), "doc_key long, groups_sha256 string")

    out = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    scored = _with_scores(blocks, key_type)
    if roots is None:
        return scored.select("doc_id", *out, "groups_sha256")
    scored = materialise(scored, "alignment-scored")
    sums = scored.where("doc_key is not null").groupBy("doc_key").agg(*[F.sum(c).alias(c) for c in out])
    zero = lambda c, empty: F.coalesce(c, F.lit(empty)).alias(c)
    long_rows = roots.join(sums, "doc_key", "left").join(digests, "doc_key", "left").select(
        "doc_id", *[zero(c, 0) for c in out], zero("groups_sha256", ""))
    return scored.where("doc_key is null").select("doc_id", *out, "groups_sha256").unionByName(long_rows)


def composed(parts: Iterable[Fragment]) -> Fragment:
    """All fragments of a document, in order."""
    return reduce(compose, parts, EMPTY)
