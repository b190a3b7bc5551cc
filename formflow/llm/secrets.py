"""Secret scan with multipart credential linking.

Strong spans (assignments of secrets, access identifiers, long hexadecimal strings) are always reported. Weak candidates
(account names, mixed tokens, endpoints) say nothing alone: they are reported only if complementary parts stand within
their scope of ``scope`` characters, found by an interval join on (document, stretch of the text).

Positions of all matches come from one replacement per pattern that puts a separator around each match and one split; the
lengths of the pieces give the positions. The separator cannot be mistaken: where a text holds it, it is exchanged for
another control character that no pattern takes, which moves nothing.

The interval join never pairs parts: each stretch of ``scope`` characters holds one row per role with the first start and
the last end of its parts, and a candidate looks up the few stretches its scope touches. As a scope is wider than a stretch,
such a row has a part within the scope exactly if last end >= scope start and first start <= scope end.

Only DataFrame operations are used. Edge cases: null and empty texts have no spans; repeated rows get the same spans, as
rows meet by a key of id and text (null ids included); positions are code points, ends exclusive; further columns are
ignored.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formflow.llm.columns import row_key, text_of
from formflow.session import materialise

_MARK, _OTHER = "\x01", "\x02"
_VALUE = r"[A-Za-z0-9+/_.=-]+"


def _either_case(word: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)


_KEYWORD = "(?:" + "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key"))) + ")"
_ACCOUNT = "(?:" + "|".join(map(_either_case, ("username", "user", "login", "account", "client_?id", "access_?key_?id"))) + ")"
_IS = r"""["']?\x20*[:=]\x20*["']?"""

#: Kind -> (pattern of head and value, least length of the value), in the order of report. The head may be empty.
STRONG: dict[str, tuple[str, int]] = {
    "assign": (rf"({_KEYWORD}{_IS})({_VALUE})", 6),
    "access": (r"()(AKIA[A-Z0-9]{16,})", 20),
    "hex": (r"()([0-9a-f]{24,})", 24),
}
WEAK: dict[str, tuple[str, int]] = {
    "account": (rf"({_ACCOUNT}{_IS})([A-Za-z0-9@+/_.=-]+)", 3),
    "mixed": (r"((?<![A-Za-z0-9+/_-])(?:AKIA[A-Z0-9]{16,}|[0-9a-f]{24,})?+)([A-Za-z0-9+/_-]{16,})", 16),
    "endpoint": (r"""((?<![A-Za-z0-9+.-])[A-Za-z][A-Za-z0-9+.-]*+://)([^\x20\x09-\x0D"'<>]+)""", 1),
}
KINDS = [*STRONG, *WEAK]
# What a mixed token starts with may be a strong span already; only what follows is a candidate. One inside an assignment is none.
#: Kinds whose spans start with the value, not with the head.
HEADLESS = {"mixed"}
#: Kind -> patterns that must all occur in the value.
HOLDS = {"mixed": ("[0-9]", "[A-Za-z]")}
#: Kind -> role of its spans.
ROLES = {"assign": "secret", "access": "identifier", "hex": "secret", "account": "identifier", "mixed": "secret", "endpoint": "endpoint"}
#: Role of a weak candidate -> roles that must all stand within its scope.
NEEDS = {"identifier": ("secret",), "secret": ("identifier",), "endpoint": ("identifier", "secret")}

_SPAN = "struct<start:int,kind:int,end:int>"


def _spans(text: Column, kind: str, pattern: str, least: int) -> Column:
    """Array of (start, kind number, end) of the leftmost non-overlapping matches whose value is long enough and holds what its kind must."""
    pieces = F.split(F.regexp_replace(text, pattern, f"{_MARK}$1{_MARK}$2{_MARK}"), _MARK)
    state = F.struct(F.lit(0).alias("i"), F.lit(0).alias("at"), F.lit(0).alias("head"), F.array().cast(f"array<{_SPAN}>").alias("out"))

    def step(a: Column, piece: Column) -> Column:
        n, third = F.length(piece), a["i"] % 3
        end = a["at"] + n
        span = F.struct(a["at" if kind in HEADLESS else "head"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end"))
        fits = reduce(and_, (piece.rlike(p) for p in HOLDS.get(kind, ())), (third == 2) & (n >= least))
        return F.struct(
            (a["i"] + 1).alias("i"), end.alias("at"), F.when(third == 0, end).otherwise(a["head"]).alias("head"),
            F.when(fits, F.concat(a["out"], F.array(span))).otherwise(a["out"]).alias("out"))

    return F.aggregate(pieces, state, step, lambda a: a["out"])


def _outside(spans: Column, assigns: Column) -> Column:
    """``spans`` without those inside one of ``assigns``, which do not overlap each other; one pass by start."""
    state = F.struct(F.lit(0).alias("to"), F.array().cast(f"array<{_SPAN}>").alias("out"))

    def step(a: Column, s: Column) -> Column:
        assign = s["kind"] == KINDS.index("assign")
        return F.struct(
            F.when(assign, s["end"]).otherwise(a["to"]).alias("to"),
            F.when(assign | (s["end"] <= a["to"]), a["out"]).otherwise(F.concat(a["out"], F.array(s))).alias("out"))

    return F.when((F.size(spans) == 0) | (F.size(assigns) == 0), spans).otherwise(
        F.aggregate(F.sort_array(F.concat(assigns, spans)), state, step, lambda a: a["out"]))


def find_parts(docs: DataFrame, carry: str | None = None) -> DataFrame:
    """Per row of ``docs``: ``key`` (null without weak spans), doc_id, ``strong`` and ``weak`` spans. Reads whole texts.

    A pattern runs only over texts that hold one of its fixed words; weak secrets and endpoints need an identifier in
    their scope, so they are looked for only in texts that may have one. The column ``carry`` goes along.
    """
    kept = [carry] if carry else []
    text, low = F.col("__t"), F.lower("__t")
    holds = lambda words: reduce(or_, (low.contains(w) for w in words))
    raw = text_of()
    rows = docs.select(*kept, "doc_id", "text", F.when(F.instr(raw, _MARK) > 0, F.translate(raw, _MARK, _OTHER)).otherwise(raw).alias("__t"))
    rows = rows.withColumns({
        "__assign": holds(("password", "passwd", "secret", "token", "apikey", "api_key")), "__access": text.contains("AKIA"),
        "__account": holds(("user", "login", "account", "clientid", "client_id", "accesskey", "access_key")), "__hex": F.lit(True),
    })
    rows = rows.withColumn("__mixed", F.col("__access") | F.col("__account"))
    rows = rows.withColumn("__endpoint", F.col("__mixed") & text.contains("://"))
    none = F.array().cast(f"array<{_SPAN}>")
    found = {kind: F.when(F.col(f"__{kind}"), _spans(text, kind, *how)).otherwise(none) for kind, how in (STRONG | WEAK).items()}
    spans = rows.select(*kept, "doc_id", "text", *[found[k].alias(f"__{k}") for k in KINDS])
    spans = spans.withColumn("__mixed", _outside(F.col("__mixed"), F.col("__assign")))
    joined = lambda kinds: F.concat(*[F.col(f"__{k}") for k in kinds])
    spans = spans.select(*kept, "doc_id", "text", joined(STRONG).alias("strong"), joined(WEAK).alias("weak"))
    return spans.select(*kept, F.when(F.size("weak") > 0, row_key("doc_id", "text")).alias("key"), "doc_id", "strong", "weak")


def link_parts(parts: DataFrame, scope: int) -> DataFrame:
    """(key, added): the weak spans whose complementary parts stand within ``scope`` characters of them."""
    role = F.element_at(F.array(*[F.lit(ROLES[k]) for k in KINDS]), F.col("s.kind") + 1)
    weak = parts.where(F.size("weak") > 0)
    spans = weak.select("key", F.explode(F.concat("strong", "weak")).alias("s")).select("key", role.alias("role"), "s.*")
    stretch = lambda a, b: F.explode(F.sequence(F.floor(F.greatest(a, F.lit(0)) / scope), F.floor(b / scope)))
    present = (spans.select("key", "role", "start", "end", stretch(F.col("start"), F.col("end") - 1).alias("at"))
               .groupBy("key", "at", "role").agg(F.min("start").alias("first"), F.max("end").alias("last")))
    wanted = (weak.select("key", F.explode("weak").alias("s")).select("key", "s", role.alias("role")).distinct()
              .withColumn("at", stretch(F.col("s.start") - scope, F.col("s.end") + scope)))
    needs = F.create_map(*[x for r, n in NEEDS.items() for x in (F.lit(r), F.array(*map(F.lit, n)))])
    found = wanted.alias("w").join(present.alias("p"), ["key", "at"]).where(
        F.array_contains(needs[F.col("w.role")], F.col("p.role"))
        & (F.col("p.last") >= F.col("s.start") - scope) & (F.col("p.first") <= F.col("s.end") + scope))
    linked = (found.groupBy("key", "s", F.col("w.role").alias("role")).agg(F.collect_set("p.role").alias("have"))
              .where(F.size("have") == F.size(needs[F.col("role")])))
    return linked.groupBy("key").agg(F.collect_list("s").alias("added"))


def scan(docs: DataFrame, scope: int = 200) -> DataFrame:
    """One row per row of ``docs``: key (null where nothing weak was found), doc_id, ``strong`` and ``added`` spans, each an array of (start, kind number, end)."""
    parts = materialise(find_parts(docs), "secret-parts")
    none = F.array().cast(f"array<{_SPAN}>")
    single = parts.where("key is null").select("key", "doc_id", "strong", none.alias("added"))
    added = link_parts(parts.where("key is not null"), scope).withColumnRenamed("key", "__key")
    linked = parts.where("key is not null").join(added, F.col("key") == F.col("__key"), "left")
    return single.unionByName(linked.select("key", "doc_id", "strong", F.coalesce("added", none).alias("added")))


def written(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed, joined by commas."""
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", name(s), s["start"], s["end"])), ",")


def masked(docs: DataFrame, scope: int = 200, mask: str = "*") -> DataFrame:
    """``docs`` with every character of a reported span replaced by ``mask``; null texts stay null.

    Spans travel with their rows; only rows with weak candidates meet the linked ones, by their key.
    """
    if len(mask) != 1:
        raise ValueError("mask must be one character, so that offsets stay")
    keyed = docs.select(F.struct("*").alias("__row"), "doc_id", "text")
    parts = find_parts(keyed, carry="__row")
    linked = link_parts(materialise(parts.drop("__row").where("key is not null").dropDuplicates(["key"]), "secret-parts"), scope)
    linked = linked.withColumnRenamed("key", "__key")
    none = F.array().cast(f"array<{_SPAN}>")
    single = parts.where("key is null").select("__row", "strong")
    both = parts.where("key is not null").join(linked, F.col("key") == F.col("__key"), "left").select(
        "__row", F.concat("strong", F.coalesce("added", none)).alias("strong"))
    text = F.col("__row.text").cast("string")
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a: Column, s: Column) -> Column:
        start, end = F.greatest(s["start"], a["at"]), F.greatest(s["end"], a["at"])
        return F.struct(end.alias("at"), F.concat(a["out"], F.substring(text, a["at"] + 1, start - a["at"]), F.repeat(F.lit(mask), end - start)).alias("out"))

    clean = F.aggregate(F.sort_array("strong"), state, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    row = F.col("__row")
    return single.unionByName(both).select(*[
        (F.when((F.size("strong") == 0) | text.isNull(), text).otherwise(clean) if c == "text" else row[c]).alias(c) for c in docs.columns])
