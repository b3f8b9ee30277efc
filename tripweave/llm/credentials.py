"""Secret scanning with multipart credential linking, by built-in expressions only.

Strong patterns are reported wherever they match. Weak ones (a user name, a short password,
a bare random string, an address) are parts of a credential at best: an interval join brings
parts of one text together that lie within a scope of each other, and a weak part is reported
only if its scope holds both an identifier and a secret.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import content_key, shielded, stored

# The strong patterns.
_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_ACCESS = r"AKIA[A-Z0-9]{12,}"
_HEX = r"[0-9a-f]{32,}"

# The weak ones: a name, a sign, a value; or a shape.
_SIGN = r"""["']?\x20*[:=]\x20*["']?"""
_NAME = rf"(?i:user_?name|user_?id|user|login|account|client_?id|access_?key_?id){_SIGN}[A-Za-z0-9+/_.@=-]{{2,}}"
_WORD = rf"(?i:passphrase|password|passwd|pass|pwd|secret_?key|secret|credential|auth_?key|private_?key){_SIGN}[^\s\"',;]{{4,}}"
_RANDOM = r"(?<![A-Za-z0-9+/])(?=[A-Za-z0-9+/]{0,39}[0-9])(?=[A-Za-z0-9+/]{0,39}[A-Z])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/])"
_PLACE = rf"""(?i:https?|ftp|ssh|postgres(?:ql)?|mysql|mongodb|redis|jdbc|amqp)://[^\s"'<>]+|(?i:host|server|endpoint){_SIGN}[A-Za-z0-9.:/_-]{{3,}}"""

SCOPE = 256
MASK = "[MASKED]"
# Group sizes of running sums: lists of matches are folded in parts.
_PART = 256
_FAR = 2**62
_OPEN, _CLOSE, _OTHER = "\x01", "\x02", "\x03"


@dataclass(frozen=True)
class Kind:
    """A pattern, the part it plays, and what a text must contain (lower-cased) to match it."""

    name: str
    role: str
    pattern: str
    cues: tuple[str, ...] = ()
    least: int = 0  # characters of the first group


BASE = (
    Kind("assign", "secret", _ASSIGN, ("passw", "secret", "token", "apikey", "api_key"), 8),
    Kind("access", "identifier", _ACCESS, ("akia",)),
    Kind("hex", "secret", _HEX),
)
WEAK = (
    Kind("identifier", "identifier", _NAME, ("user", "login", "account", "client", "access")),
    Kind("secret", "secret", _WORD, ("pass", "pwd", "secret", "credential", "key")),
    Kind("random", "secret", _RANDOM),
    Kind("endpoint", "endpoint", _PLACE, ("://", "host", "server", "endpoint")),
)
KINDS = (*BASE, *WEAK)
_NUMBER = {kind.name: at for at, kind in enumerate(KINDS)}
_SPANS = "array<struct<start:bigint,kind:int,end:bigint>>"


def _long(number: int) -> Column:
    return F.lit(number).cast("bigint")


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once a row, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _before(numbers: Column, zero: Column, joined: Callable[[Column, Column], Column]) -> Column:
    """For each number what ``joined`` makes of ``zero`` and the numbers before it."""
    empty = F.expr("cast(array() AS array<bigint>)")

    def fold(part: Column, start: Column) -> Column:
        first = F.struct(start.alias("sum"), empty.alias("sums"))

        def step(state: Column, n: Column) -> Column:
            return F.struct(
                joined(state["sum"], n).alias("sum"), F.array_append(state["sums"], state["sum"]).alias("sums")
            )

        return F.aggregate(part, first, step, lambda state: state["sums"])

    def folded(parts: Column) -> Column:
        sums = F.transform(parts, lambda part: F.aggregate(part, zero, joined))
        return F.flatten(F.zip_with(parts, fold(sums, zero), fold))

    return _once(_once(numbers, _parts), folded)


def _parts(values: Column) -> Column:
    """An array in arrays of ``_PART``; an empty one gives one empty part."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(values), F.lit(1)), F.lit(_PART))
    return F.transform(starts, lambda i: F.slice(values, i, _PART))


def _spans(text: Column, low: Column, kind: Kind) -> Column:
    """Start and end of each match of a kind, in code points.

    Matches are put between two marks, the text is cut at them, and lengths are summed up.
    Marks that the text holds itself become another sign of the same length first; no
    pattern tells them apart.
    """
    plain = F.translate(text, _OPEN + _CLOSE, _OTHER + _OTHER)
    marked = F.regexp_replace(plain, F.lit(kind.pattern), F.lit(f"{_OPEN}$0{_CLOSE}"))
    number = F.lit(_NUMBER[kind.name])

    def matches(pieces: Column) -> Column:
        sizes = F.transform(pieces, lambda p: F.length(F.translate(p, _CLOSE, "")).cast("bigint"))
        starts = _before(sizes, _long(0), lambda at, n: at + n)
        rows = F.zip_with(starts, pieces, lambda at, p: F.struct(at.alias("start"), p.alias("piece")))
        rows = F.filter(rows, lambda x: F.contains(x["piece"], F.lit(_CLOSE)))
        if kind.least:
            value = lambda x: F.regexp_extract(
                F.substring_index(x["piece"], _CLOSE, 1), kind.pattern, 1
            )
            rows = F.filter(rows, lambda x: F.length(value(x)) >= kind.least)
        return F.transform(
            rows,
            lambda x: F.struct(
                x["start"].alias("start"),
                number.alias("kind"),
                (x["start"] + F.instr(x["piece"], _CLOSE) - 1).alias("end"),
            ),
        ).cast(_SPANS)

    spans = _once(F.split(marked, _OPEN), matches)
    held = text.isNotNull()
    if kind.cues:
        cue = F.lit(False)
        for word in kind.cues:
            cue = cue | F.contains(low, F.lit(word))
        held = held & cue
    else:
        held = held & F.regexp_like(text, F.lit(kind.pattern))
    return F.when(held, spans).otherwise(F.expr(f"cast(array() AS {_SPANS})"))


def base_spans(text: Column) -> Column:
    """The strong spans of a text, by start and kind; none for null."""
    low = F.lower(text)
    return F.array_sort(F.concat(*(_spans(text, low, kind) for kind in BASE)))


def _weak_spans(text: Column) -> Column:
    low = F.lower(text)
    return F.concat(*(_spans(text, low, kind) for kind in WEAK))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's id, its ``base`` spans and the ``linked`` weak ones, each by start and kind.

    Spans are (``start``, ``kind`` as its place in ``KINDS``, ``end``) in code points, end
    exclusive. Weak parts that overlap a strong span are left to it. A null text is an empty
    one; repeated rows come back as often as given.
    """
    return _scanned(docs, id_col, text_col).drop("key")


def _scanned(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows, (key, text) = shielded(docs, id_col, text_col)
    body = F.col(text)
    rows = rows.select(
        F.col(key).alias("id"),
        content_key(key, text).alias("key"),
        base_spans(body).alias("base"),
        _weak_spans(body).alias("weak"),
    )
    rows = stored(rows, "spans")
    linked = stored(_linked(rows), "linked")
    found = rows.select("id", "key", "base").join(linked, "key", "left")
    none = F.expr(f"cast(array() AS {_SPANS})")
    return found.select(
        "key", F.col("id").alias(id_col), "base", F.coalesce("linked", none).alias("linked")
    )


def _linked(rows: DataFrame) -> DataFrame:
    """``key`` and ``linked``: the weak spans whose scope holds an identifier and a secret.

    Parts meet in cells of a scope's width, so a text with very many parts is joined cell by
    cell, and a cell has room for few.
    """
    roles = F.array(*(F.lit(kind.role) for kind in KINDS))
    rows = rows.where(F.size("weak") > 0).dropDuplicates(["key"])
    rows = rows.select("key", _once(F.array_sort(F.concat("base", "weak")), _clear).alias("parts"))
    parts = rows.select("key", F.explode("parts").alias("s")).select(
        "key",
        "s.*",
        F.element_at(roles, F.col("s.kind") + 1).alias("role"),
        F.expr(f"explode(sequence(s.start div {SCOPE}, (s.end - 1) div {SCOPE}))").alias("cell"),
    )
    weak = parts.where(F.col("kind") >= len(BASE)).drop("role", "cell").distinct()
    around = weak.withColumn(
        "cell", F.expr(f"explode(sequence((start - {SCOPE}) div {SCOPE} - 1, (end + {SCOPE}) div {SCOPE}))")
    )
    a, b = around.alias("a"), parts.alias("b")
    near = (F.col("b.start") <= F.col("a.end") + SCOPE) & (F.col("a.start") <= F.col("b.end") + SCOPE)
    same = (F.col("a.key") == F.col("b.key")) & (F.col("a.cell") == F.col("b.cell"))
    met = a.join(b, same & near).groupBy("a.key", "a.start", "a.kind", "a.end").agg(
        *(F.max((F.col("b.role") == role).cast("int")).alias(role) for role in ("identifier", "secret"))
    )
    met = met.where("identifier = 1 AND secret = 1")
    span = F.struct("start", "kind", "end")
    return met.groupBy("key").agg(F.array_sort(F.collect_list(span)).cast(_SPANS).alias("linked"))


def _clear(spans: Column) -> Column:
    """Of spans by start the strong ones, and the weak ones that overlap none of them."""
    strong = lambda s: s["kind"] < len(BASE)
    ends = F.transform(spans, lambda s: F.when(strong(s), s["end"]).otherwise(_long(0)))
    starts = F.transform(F.reverse(spans), lambda s: F.when(strong(s), s["start"]).otherwise(_long(_FAR)))
    reached = _before(ends, _long(0), lambda a, b: F.greatest(a, b))
    ahead = F.reverse(_before(starts, _long(_FAR), lambda a, b: F.least(a, b)))
    around = F.zip_with(reached, ahead, lambda r, a: F.struct(r.alias("reached"), a.alias("ahead")))
    rows = F.zip_with(around, spans, lambda x, s: F.struct(x.alias("around"), s.alias("span")))
    free = lambda x: (x["around"]["reached"] <= x["span"]["start"]) & (x["span"]["end"] <= x["around"]["ahead"])
    return F.transform(F.filter(rows, lambda x: strong(x["span"]) | free(x)), lambda x: x["span"])


def written(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*(F.lit(kind.name) for kind in KINDS))
    shown = F.transform(
        spans,
        lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(shown, ",")


def masked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """``docs`` with every reported span replaced by a mask; a numeric ``size_col`` follows.

    Strong spans are found in place; the few texts with linked weak parts are looked up.
    """
    linked = _scanned(docs, id_col, text_col).where(F.size("linked") > 0)
    linked = stored(linked.select("key", "linked").dropDuplicates(["key"]), "masks")
    text = F.col(text_col)
    rows = docs.withColumn("_key_", content_key(id_col, text_col))
    rows = rows.join(linked.withColumnsRenamed({"key": "_key_", "linked": "_linked_"}), "_key_", "left")
    none = F.expr(f"cast(array() AS {_SPANS})")
    rows = rows.withColumn("_spans_", F.array_sort(F.concat(base_spans(text), F.coalesce("_linked_", none))))
    hidden = F.size("_spans_") > 0
    rows = rows.withColumn(text_col, F.when(hidden, _hidden(text, F.col("_spans_"))).otherwise(text))
    if size_col in docs.columns:
        kind = docs.schema[size_col].dataType.simpleString()
        if kind in ("bigint", "int"):
            size = F.when(hidden, F.length(text).cast(kind)).otherwise(F.col(size_col))
            rows = rows.withColumn(size_col, size)
    return rows.select(*(F.col(f"`{name}`") for name in docs.columns))


def _hidden(text: Column, spans: Column) -> Column:
    """``text`` with a mask for each run of overlapping spans, which come by start.

    What stays is cut in two steps, a part of the text and pieces of that, so that no piece is
    looked for from the start of a long text.
    """
    ends = lambda spans: F.transform(spans, lambda s: s["end"])

    def shown(spans: Column) -> Column:
        reached = _before(ends(spans), _long(0), lambda a, b: F.greatest(a, b))
        rows = F.zip_with(reached, spans, lambda a, s: F.struct(a.alias("a"), s["start"].alias("z")))
        last = F.struct(F.array_max(ends(spans)).alias("a"), F.length(text).cast("bigint").alias("z"))
        return F.concat(F.filter(rows, lambda x: x["a"] <= x["z"]), F.array(last))

    def cut(whole: Column, base: Column, a: Column, z: Column) -> Column:
        return F.substring(whole, (a - base + 1).cast("int"), (z - a).cast("int"))

    def block(part: Column) -> Column:
        first, last = F.element_at(part, 1)["a"], F.element_at(part, -1)["z"]
        return F.struct(part.alias("part"), first.alias("from"), cut(text, _long(0), first, last).alias("piece"))

    def joined(b: Column) -> Column:
        pieces = F.transform(b["part"], lambda x: cut(b["piece"], b["from"], x["a"], x["z"]))
        return F.array_join(pieces, MASK)

    blocks = F.transform(_once(_once(spans, shown), _parts), block)
    return F.array_join(F.transform(blocks, joined), MASK)
