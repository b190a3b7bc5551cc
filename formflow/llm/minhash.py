"""Near-duplicates from bottom-k sketches of one hash function.

A document's set holds the hashes of its distinct word shingles; its sketch is the ``SKETCH`` smallest of them.

1. Classes. Documents with equal sets are one class, whatever their number; all further work is on classes.
2. Inverted lists. Two sets with similarity 0.8 have, of the ``SKETCH`` smallest values of their union, about 80 % in
   common, and fewer than ``SHARED`` with probability below 1e-9. So they also meet in one of the rarest
   ``SKETCH - SHARED + 1`` values of both, by any global order: each class lists only those, rarest first by a frequency
   table of bounded size. Values that very many different documents share (boilerplate) are thus mostly never listed. Sets
   smaller than a sketch are listed by the same rule with their own size, which is exact.
3. Pairs. A list gives no pairs of its members: each member meets the list's pivots (its most typical, least typical,
   first and last class). A class is first checked against the pivot it shares most lists with, then against pivots still in
   other components: all of them where a list has at most ``FEW`` members, which pivots cover, and of longer lists the
   ``FURTHER`` that it shares most with, as whatever these leave open comes up again below. Of lists that still span several components, short ones give all their pairs, and long ones
   neighbours, each list in a random order of its own. Classes of long lists that are open even then and have ``SHARED``
   sketch values in common with other components (``enough_in_common``) meet on their full sets: exact counts rule out each
   class with too many values of its own, and the others meet in the rarest values, where their places and parity words
   rule out most pairs that are not similar (``remaining_pairs``).
   So a group of n near copies costs in the order of n checks, and no link between components is lost.
4. Check. The sketch of the union estimates the similarity and drops pairs more than six standard deviations below the
   threshold; the others are confirmed on their full sets.
5. Components of confirmed links, by contraction.

Sets of 64-bit hashes stand for the shingles themselves. Edge cases: a text with fewer words than a shingle is one shingle,
the whole sequence; a null, empty or blank text has an empty set, is linked with nothing and is its own component; repeated
rows are in one class; the component of rows without any id is null; empty tables give empty results; further columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from formflow.llm.batches import slices
from formflow.llm.bitmaps import bitmap_of, collected, held, holding
from formflow.llm.columns import row_key
from formflow.llm.components import connected_components
from formflow.llm.hashing import run_hashes, word_hashes
from formflow.session import arrow_batches, intermediates, materialise

SKETCH, SHARED = 64, 30
#: Pairs of one class that are checked because they are neighbours in lists; all others go the exact way.
NEIGHBOURS = 8
#: Members of a list that its pivots cover, so that all pairs with them are checked; and pivots of longer lists for each
#: class in the second pass.
FEW, FURTHER = 3, 2
#: Members of a list whose pairs are all checked if it is open after the pivots: at most ``SHORT - 1`` for each member.
SHORT = 8
#: log2 of the number of counters in the frequency table.
COUNTER_BITS = 20
#: 64-bit words of parities of a full set.
PARITY_WORDS = 8
PARITIES = [f"parity_{i}" for i in range(PARITY_WORDS)]


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles."""
    words, owner = word_hashes(column)
    per_text = np.bincount(owner, minlength=len(column))
    ends = np.cumsum(per_text)
    runs, at = run_hashes(words, owner, tuple(range(size)))
    last = np.searchsorted(at, ends)
    first = np.searchsorted(at, ends - per_text)
    for i in range(len(column)):
        if per_text[i] >= size:
            yield np.unique(runs[first[i] : last[i]])
        elif per_text[i]:
            short = words[ends[i] - per_text[i] : ends[i]]
            yield run_hashes(short, np.zeros(len(short), np.int64), tuple(range(len(short))), 1000 + len(short))[0]
        else:
            yield np.zeros(0, np.uint64)


def _list_of(arrays: list[np.ndarray]) -> pa.Array:
    borders = np.r_[0, np.cumsum([len(a) for a in arrays])].astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(borders), pa.array(values.view(np.int64)))


def _sketches(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                sets = list(shingle_sets(batch.column("text"), size))
                prints = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                ids = [c for c in batch.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ids), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints, pa.binary()), _list_of([s[:SKETCH] for s in sets])],
                    [*ids, "n", "print", "sketch"])

    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << COUNTER_BITS, dtype=np.int64)
    for batch in batches:
        values = np.asarray(batch.column("sketch").flatten(), dtype=np.int64).view(np.uint64)
        total += np.bincount((values >> np.uint64(64 - COUNTER_BITS)).astype(np.int64), minlength=len(total))
    slot = np.flatnonzero(total)
    if len(slot):
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(total[slot])], ["slot", "n"])


def _listed(frequency: np.ndarray, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, owner, score = [], [], []
            for i, sketch in enumerate(batch.column("sketch")):
                own = np.asarray(sketch.values, dtype=np.int64).view(np.uint64)
                count = frequency[(own >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)]
                keep = len(own) - min(SHARED, int(np.ceil(threshold * len(own) - 1e-9))) + 1
                values.append(own[np.lexsort((own, count))[:keep]])
                owner.append(np.full(len(values[-1]), i))
                score.append(count.mean() if len(own) else 0.0)
            if values:
                which = np.concatenate(owner)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(values).view(np.int64)), batch.column("cls").take(pa.array(which)), batch.column("n").take(pa.array(which)),
                     pa.array(np.array(score, dtype=np.float32)[which])], ["value", "cls", "n", "score"])

    return run


def inverted_lists(classes: DataFrame, threshold: float) -> DataFrame:
    """(value, cls, n, score): the rarest sketch values of each class; ``score`` tells how common its values are."""
    slots, counts = collected(classes.select("sketch").mapInArrow(_counted, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")))
    frequency = np.zeros(1 << COUNTER_BITS, dtype=np.int32)
    frequency[slots] = np.minimum(counts, 2**31 - 1)
    return classes.select("cls", "n", "sketch").mapInArrow(_listed(frequency, threshold), "value long, cls long, n long, score float")


def _similar_sizes(a: str, b: str, threshold: float):
    return (F.col(a) >= threshold * F.col(b)) & (F.col(b) >= threshold * F.col(a))


def shared_lists(lists: DataFrame) -> DataFrame:
    """The lists of several members, with their ``size``.

    Most lists have one member. They are counted by their values alone, and a bitmap of bounded size keeps them from moving.
    """
    sizes = materialise(lists.groupBy("value").agg(F.count("*").alias("size")).where("size > 1"), "minhash-sizes")
    return materialise(holding(lists, F.col("value"), *bitmap_of(sizes, "value")).join(sizes, "value"), "minhash-lists")


def pivot_pairs(lists: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(cls, pivot, votes, few): each class with the pivots of its lists, and the lists of over ``FEW`` members.

    ``few`` tells that the two are in a list of at most ``FEW`` members.
    """
    me = F.struct("cls", "n")
    shared = shared_lists(lists)
    pivots = shared.groupBy("value").agg(
        F.max(F.struct("score", "cls", "n")).alias("p"), F.min(F.struct("score", "cls", "n")).alias("q"), F.max(me).alias("r"), F.min(me).alias("s"))
    four = F.array_distinct(F.array(*[F.struct(F.col(f"{p}.cls").alias("cls"), F.col(f"{p}.n").alias("n")) for p in "pqrs"]))
    pivots = materialise(pivots.select("value", four.alias("pivots")), "minhash-pivots")
    pairs = shared.join(pivots, "value").select("cls", "n", "size", F.explode("pivots").alias("p")).select("cls", "n", "size", F.col("p.cls").alias("pivot"), F.col("p.n").alias("m"))
    pairs = pairs.where((F.col("cls") != F.col("pivot")) & _similar_sizes("n", "m", threshold)).groupBy("cls", "pivot").agg(F.count("*").alias("votes"), (F.min("size") <= FEW).alias("few"))
    return materialise(pairs, "minhash-pairs"), shared.where(F.col("size") > FEW).select("value", "cls", "n", "size")


def _estimated(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for sa, sb, na, nb in zip(batch.column("sa"), batch.column("sb"), batch.column("na").to_pylist(), batch.column("nb").to_pylist()):
                a, b = (np.asarray(s.values, dtype=np.int64).view(np.uint64) for s in (sa, sb))
                whole = na <= SKETCH and nb <= SKETCH
                if not whole:  # only up to the smaller of the largest values is the union's sketch known
                    top = min(s[-1] for s, n in ((a, na), (b, nb)) if n > SKETCH)
                    a, b = a[a <= top], b[b <= top]
                both = len(np.intersect1d(a, b, assume_unique=True))
                union = len(a) + len(b) - both
                slack = 0.0 if whole else 6 * np.sqrt(threshold * (1 - threshold) * union)
                keep.append(both >= threshold * union - slack - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _sets(size: int, bits: int, bitmap: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[bytes] = set()
        for whole in batches:
            for batch in slices(whole, "text"):
                prints, sets = [], []
                for s in shingle_sets(batch.column("text"), size):
                    name = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                    if name not in given and len(s) and held(np.frombuffer(name[:8], dtype=">u8").astype(np.uint64), bits, bitmap)[0]:
                        given.add(name)
                        prints.append(name)
                        sets.append(s.tobytes())
                if prints:
                    yield pa.RecordBatch.from_arrays([pa.array(prints, pa.binary()), pa.array(sets, pa.binary())], ["print", "members"])

    return run


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("ma"), batch.column("mb")):
                a, b = (np.frombuffer(m.as_buffer(), dtype=np.uint64) for m in (x, y))
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _side(table: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    return table.select(F.col("cls").alias(key), *[F.col(c).alias(n) for c, n in columns.items()])


def _sketches_of(wanted: DataFrame, classes: DataFrame) -> DataFrame:
    """(cls, n, sketch) of the wanted classes and a few others: a bitmap of bounded size keeps most sketches from moving."""
    bits, bitmap = bitmap_of(wanted.select(F.xxhash64("cls").alias("__hash")), "__hash")
    return holding(classes.select("cls", "n", "sketch"), F.xxhash64("cls"), bits, bitmap)


def full_sets(wanted: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """(cls, members) of the wanted classes (cls, print): their whole sets, made anew from the texts.

    A bitmap of bounded size keeps other texts' sets from moving; a task sends each set once.
    """
    wanted = materialise(wanted.select("cls", "print", F.conv(F.substring(F.hex("print"), 1, 16), 16, -10).cast("long").alias("__hash")), "minhash-wanted")
    found = texts.mapInArrow(_sets(size, *bitmap_of(wanted, "__hash")), "print binary, members binary")
    # Repeated sets go before the join, which then needs no further shuffle of the members.
    return materialise(found.dropDuplicates(["print"]).join(wanted.select("print", "cls"), "print").select("cls", "members"), "minhash-sets")


def classes_of(pairs: DataFrame) -> DataFrame:
    """(cls): the classes of the pairs (a, b), worked out once."""
    return materialise(pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct(), "minhash-members")


def confirm(pairs: DataFrame, classes: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose sets are similar enough: estimated on sketches, then confirmed on full sets."""
    sketches = _sketches_of(classes_of(pairs), classes)
    known = pairs.join(_side(sketches, "a", {"sketch": "sa", "n": "na"}), "a").join(_side(sketches, "b", {"sketch": "sb", "n": "nb"}), "b")
    likely = materialise(known.mapInArrow(_estimated(percent / 100), "a long, b long"), "minhash-likely")
    if likely.isEmpty():
        return likely
    wanted = classes_of(likely).join(classes.select("cls", "print"), "cls")
    sets = full_sets(wanted, texts, size)
    full = likely.join(_side(sets, "a", {"members": "ma"}), "a").join(_side(sets, "b", {"members": "mb"}), "b")
    return materialise(full.mapInArrow(_confirmed(percent), "a long, b long"), "minhash-links")


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for cls, root, members in zip(batch.column("cls").to_pylist(), batch.column("root").to_pylist(), batch.column("members")):
            own = np.frombuffer(members.as_buffer(), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), cls)), pa.array(np.full(len(own), root)), pa.array(own)], ["cls", "root", "value"])


def parities(members: np.ndarray) -> np.ndarray:
    """``PARITY_WORDS`` words of bits: bit i tells whether an odd number of members falls into slot i."""
    bits = 64 * PARITY_WORDS
    odd = np.bincount((members & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _parity_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            words = np.stack([parities(np.frombuffer(m.as_buffer(), dtype=np.uint64)) for m in batch.column("members")])
            yield pa.RecordBatch.from_arrays([batch.column("cls"), *(pa.array(w) for w in np.ascontiguousarray(words.T))], ["cls", *PARITIES])


def remaining_pairs(open_classes: DataFrame, classes: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b): all pairs of the open classes (cls, root) that may be similar and have different roots.

    Exact, on full sets. Values that one root alone holds are in no such pair's intersection. With s other values of n, two
    classes have at most min(s) in common. Classes that may reach the threshold with that meet in the rarest values of both,
    of which a similar pair shares one (the prefix of n - 0.8 n + 1 values). A pair stays if it may still be similar where it
    meets: if a value is the first that both have, they share at most it and what follows it in both; and as their sets
    differ in at least as many members as their parity words differ in bits, these bound what is common as well. A similar
    pair passes all three bounds at its first common value.
    """
    wanted = open_classes.join(classes.select("cls", "print", "n"), "cls")
    sets = full_sets(wanted, texts, size)
    placed = sets.join(open_classes.select("cls", "root"), "cls")
    values = materialise(placed.mapInArrow(_values, "cls long, root long, value long"), "minhash-values")
    several = F.min("root") != F.max("root")
    counts = materialise(values.groupBy("value").agg(F.count("*").alias("df"), several.alias("several")).where("several").drop("several"), "minhash-counts")
    shared = materialise(values.drop("root").join(counts, "value"), "minhash-shared")
    sums = shared.groupBy("cls").agg(F.count("*").alias("s")).join(wanted.select("cls", "n", "root"), "cls").where(100 * F.col("s") >= percent * F.col("n"))
    words = sets.mapInArrow(_parity_rows, "cls long, " + ", ".join(f"{c} long" for c in PARITIES))
    sums = materialise(sums.join(words, "cls"), "minhash-possible")
    nth = F.row_number().over(Window.partitionBy("cls").orderBy("df", "value")) + F.col("n") - F.col("s")
    lists = shared.join(sums, "cls").withColumn("nth", nth).where(F.col("nth") <= F.col("n") - F.ceil(percent * F.col("n") / 100) + 1)
    own = ["cls", "n", "s", "root", "nth", *PARITIES]
    lists = materialise(lists.select("value", *own), "minhash-rare")
    other = lists.select("value", *[F.col(c).alias(f"o_{c}") for c in own])
    differ = reduce(add, (F.bit_count(F.col(c).bitwiseXOR(F.col(f"o_{c}"))) for c in PARITIES))
    both = F.col("n") + F.col("o_n")
    most = F.least(F.least("s", "o_s").cast("long"), 1 + F.least(F.col("n") - F.col("nth"), F.col("o_n") - F.col("o_nth")), F.shiftright(both - differ, 1))
    met = lists.join(other, "value").where((F.col("cls") < F.col("o_cls")) & (F.col("root") != F.col("o_root")) & (100 * most >= percent * (both - most)))
    return _ordered(met, "cls", "o_cls")


def _ordered(pairs: DataFrame, x: str, y: str) -> DataFrame:
    return pairs.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (a, b, and further columns) that are not in one component yet."""
    names = pairs.columns
    for c in "ab":
        of = roots.select(F.col("node").alias("__node"), F.col("root").alias(f"__r{c}"))
        pairs = pairs.join(of, pairs[c] == of["__node"], "left").drop("__node")
    return pairs.where(F.coalesce("__ra", "a") != F.coalesce("__rb", "b")).select(*names)


def further_pairs(pairs: DataFrame, first: DataFrame, roots: DataFrame) -> DataFrame:
    """(a, b): classes with pivots of their lists in other components, without those checked first.

    All pivots of lists of at most ``FEW`` members, and of longer lists the ``FURTHER`` that a class shares most lists with.
    """
    checked = first.unionByName(first.select(F.col("b").alias("a"), F.col("a").alias("b")))
    apart = _apart(pairs.select(F.col("cls").alias("a"), F.col("pivot").alias("b"), "votes", "few").join(checked, ["a", "b"], "left_anti"), roots)
    apart = materialise(apart, "minhash-apart")
    most = F.slice(F.sort_array(F.collect_list(F.struct("votes", "b")), asc=False), 1, FURTHER)
    some = apart.where("not few").groupBy("a").agg(most.alias("most")).select("a", F.explode("most.b").alias("b"))
    return _ordered(apart.where("few").select("a", "b").unionByName(some), "a", "b")


def open_lists(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """(value, cls, n, size, root) of the lists that still span several components."""
    placed = lists.join(roots, lists.cls == roots.node, "left").select("value", "cls", "n", "size", F.coalesce("root", "cls").alias("root"))
    several = placed.groupBy("value").agg((F.min("root") != F.max("root")).alias("open")).where("open").select(F.col("value").alias("__value"))
    return materialise(placed.join(several, F.col("value") == F.col("__value")).drop("__value"), "minhash-open-lists")


def _adjacent(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.zeros((4, 0), dtype=np.int64)
        for batch in batches:
            rows = np.concatenate([last, np.stack([np.asarray(batch.column(c), dtype=np.int64) for c in ("value", "cls", "n", "root")])], axis=1)
            last = rows[:, -1:]
            x, y = rows[:, :-1], rows[:, 1:]
            small, large = np.minimum(x[2], y[2]), np.maximum(x[2], y[2])
            fits = (x[0] == y[0]) & (x[3] != y[3]) & (small >= threshold * large)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x[1], y[1])[fits]), pa.array(np.maximum(x[1], y[1])[fits])], ["a", "b"])

    return run


def neighbour_pairs(opened: DataFrame, threshold: float) -> DataFrame:
    """(a, b): classes of different components that stand side by side in an open list, at most ``NEIGHBOURS`` for each a.

    Each list has a random order of its own, so a class gets other neighbours in each. A group whose members are similar
    to some share of each other only, which a few pivots leave in pieces, becomes one component by a number of checks that
    follows its size; what stays apart is left to ``remaining_pairs``. Lists lie across range partitions, however long.
    """
    mixed = opened.withColumn("mix", F.xxhash64("value", "cls")).repartitionByRange("value", "mix").sortWithinPartitions("value", "mix")
    pairs = mixed.select("value", "cls", "n", "root").mapInArrow(_adjacent(threshold), "a long, b long").distinct()
    some = F.slice(F.sort_array(F.collect_list(F.struct(F.xxhash64("a", "b").alias("mix"), "b"))), 1, NEIGHBOURS)
    return pairs.groupBy("a").agg(some.alias("near")).select("a", F.explode("near.b").alias("b"))


def short_list_pairs(opened: DataFrame, threshold: float) -> DataFrame:
    """(a, b): all pairs of classes of different components in the lists of at most ``SHORT`` members."""
    short = opened.where(F.col("size") <= SHORT)
    other = short.select("value", *[F.col(c).alias(f"o_{c}") for c in ("cls", "n", "root")])
    met = short.join(other, "value").where((F.col("cls") < F.col("o_cls")) & (F.col("root") != F.col("o_root")) & _similar_sizes("n", "o_n", threshold))
    return _ordered(met, "cls", "o_cls")


def enough_in_common(open_classes: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """The open classes (cls, root) of which as many sketch values are in open classes of other roots as a similar pair shares.

    That number is the one that the inverted lists go by. Values that one root alone holds are in no pair's intersection.
    """
    sketches = open_classes.join(_sketches_of(open_classes, classes).select("cls", "sketch"), "cls")
    needed = F.least(F.lit(SHARED), F.ceil(threshold * F.size("sketch") - 1e-9))
    values = materialise(sketches.select("cls", "root", needed.alias("needed"), F.explode("sketch").alias("value")), "minhash-sketch-values")
    several = values.groupBy("value").agg((F.min("root") != F.max("root")).alias("several")).where("several").select("value")
    counts = values.join(several, "value").groupBy("cls", "root").agg(F.count("*").alias("common"), F.first("needed").alias("needed"))
    return counts.where("common >= needed").select("cls", "root")


def link_classes(classes: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(node, root) for all classes that have a confirmed link."""
    threshold = percent / 100
    pairs, long_lists = pivot_pairs(inverted_lists(classes, threshold), threshold)
    best = pairs.groupBy("cls").agg(F.max_by("pivot", F.struct("votes", "pivot")).alias("pivot"))
    first = materialise(_ordered(best, "cls", "pivot"), "minhash-first")
    links = confirm(first, classes, texts, size, percent)
    roots = connected_components(links)
    second = materialise(further_pairs(pairs, first, roots), "minhash-second")
    links = links.unionByName(confirm(second, classes, texts, size, percent))
    roots = connected_components(links)
    opened = open_lists(long_lists, roots)
    if opened.isEmpty():
        return roots
    is_long = F.col("size") > SHORT
    third = neighbour_pairs(opened.where(is_long), threshold).unionByName(short_list_pairs(opened, threshold)).distinct()
    third = materialise(third.join(first, ["a", "b"], "left_anti").join(second, ["a", "b"], "left_anti"), "minhash-third")
    links = links.unionByName(confirm(third, classes, texts, size, percent))
    roots = connected_components(links)
    open_classes = open_lists(opened.where(is_long).drop("root"), roots).select("cls", "root").distinct()
    open_classes = materialise(enough_in_common(open_classes, classes, threshold), "minhash-open")
    if open_classes.isEmpty():
        return roots
    rest = remaining_pairs(open_classes, classes, texts, size, percent)
    for checked in (first, second, third):
        rest = rest.join(checked, ["a", "b"], "left_anti")
    last = confirm(materialise(rest, "minhash-rest"), classes, texts, size, percent)
    return roots if last.isEmpty() else connected_components(links.unionByName(last))


def near_duplicates(docs: DataFrame, ids: list[str], order: str, size: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs``: ``ids``, ``n`` (size of its set), ``print`` (of its set) and ``component``.

    The component is the smallest value of the column ``order`` (one of ``ids``) in the row's component; a row with an
    empty set has its own value.
    """
    with intermediates(docs.sparkSession), arrow_batches(docs.sparkSession):
        source = docs.select(*ids, F.col("text").cast("string").alias("text"))
        kinds = ", ".join(f"`{c}` {t}" for c, t in source.dtypes if c != "text")
        rows = materialise(source.mapInArrow(_sketches(size), kinds + ", n long, print binary, sketch array<long>"), "minhash-rows")
        classes = rows.where("n > 0").groupBy("print").agg(F.min(order).alias("least"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
        classes = materialise(classes.withColumn("cls", F.monotonically_increasing_id()), "minhash-classes")
        roots = link_classes(classes, source.select("text"), size, percent)
        placed = classes.join(roots, classes.cls == roots.node, "left").select("print", "least", F.coalesce("root", "cls").alias("root"))
        smallest = placed.groupBy("root").agg(F.min("least").alias("component")).withColumnRenamed("root", "__root")
        named = materialise(placed.join(smallest, placed.root == smallest["__root"]).select(F.col("print").alias("__print"), "component"), "minhash-components")
        full = rows.where("n > 0").join(named, F.col("print") == F.col("__print")).select(*ids, "n", "print", "component")
        out = full.unionByName(rows.where("n = 0").select(*ids, "n", "print", F.col(order).alias("component")))
        return materialise(out, "minhash-out", keep=True)


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, the one with the smallest doc_id, and its own columns.

    Rows without an id come last. Rows equal in id and text are one document, of which one row stays.
    """
    keyed = docs.select(F.struct("*").alias("__row"), "doc_id", "text", row_key("doc_id", "text").alias("__key"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("__key").alias("key"))
    with intermediates(docs.sparkSession):
        found = near_duplicates(keyed.select(order.alias("__order"), "text"), ["__order"], "__order", size, percent)
        kept = materialise(found.where("__order = component").select(F.col("__order.key").alias("__key")).distinct(), "minhash-kept", keep=True)
    return keyed.join(kept, "__key", "left_semi").dropDuplicates(["__key"]).select("__row.*")
