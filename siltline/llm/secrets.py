"""Secrets in whole texts, and credentials that come in several parts.

Strong candidates are reported wherever they stand: assignments of passwords and tokens, access
identifiers of a fixed form, and long hexadecimal runs.  Weak candidates (account names, short
or loosely named secrets, endpoints) are common in clean text.  They are reported only where
parts that complete each other meet: a secret with an identifier or an endpoint.  Parts are
joined by interval: a scope is ``SCOPE`` code points long, scopes begin every half of that, and
each part belongs to the scopes that its beginning lies in.  Two parts whose beginnings are half
a scope or less apart share one; two that are a scope or more apart share none.  What lies between
depends on where in the text the parts stand, unless scopes are ``sliding``: then they begin at every
code point, and two parts share one if their beginnings are less than a scope apart.  Sliding scopes
report all that the others report.

Plan: one scan, no shuffle; everything happens within the row.  Positions are running sums over
the lengths between matches, taken by parts; masked texts are joined from pieces.  The work grows
with the text and the matches, but for a share of (matches / 256)^2 / 2 copied numbers.

NULL is an empty text and has no spans.  Positions are code points, ends are exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ASSIGN, ACCESS, HEX = "assign", "access", "hex"
# The forms of strong candidates.  Group 2 of an assignment is the value.
STRONG = {
    ASSIGN: r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    ACCESS: r"AKIA[A-Z0-9]+",
    HEX: r"[0-9a-f]{32,}",
}
LEAST = {ASSIGN: 8, ACCESS: 16, HEX: 32}
# The forms of weak candidates.
WEAK = {
    "weak_id": r"""(?<![A-Za-z0-9_])(?i:(?:user(?:_?name|_?id)?|login|account|client_?id|access_?key(?:_?id)?))["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.@-]{3,}""",
    "weak_secret": r"""(?<![A-Za-z0-9_])(?i:(?:pwd|pass|passphrase|auth|credential|client_?secret|private_?key|secret_?(?:access_?)?key))["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{4,}""",
    "endpoint": r"(?<![A-Za-z0-9_])(?i:(?:https?|ftp|jdbc:[a-z0-9]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[A-Za-z0-9._~:/?#@!&=%+-]+)",
}
KINDS = (ASSIGN, ACCESS, HEX, *WEAK)
IDENTIFIERS = (ACCESS, "weak_id")
SECRETS = (ASSIGN, HEX, "weak_secret")
ENDPOINTS = ("endpoint",)
SCOPE = 600
MASK = "[SECRET]"
PART = 256  # numbers that are folded in one go
PIECE = 1024  # code points of a piece of text

_SPANS = "array<struct<start:int,end:int,kind:int>>"


def _none() -> Column:
    return F.array().cast(_SPANS)


def _let(value: Column, use) -> Column:
    """``use`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _before(numbers: Column, fold) -> Column:
    """For each number the fold of those before it, 0 for the first.

    A fold that gathers an array copies it at each step, so the numbers are folded by parts of
    ``PART``, and the parts' folds are carried on.
    """

    def steps(some: Column, first: Column) -> Column:
        start = F.struct(first.alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(
            some,
            start,
            lambda acc, n: F.struct(
                fold(acc["at"], n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")
            ),
            lambda acc: acc["out"],
        )

    def parts(some: Column) -> Column:
        last = F.greatest(F.ceil(F.size(some) / PART).cast("int") - 1, F.lit(0))
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(some, k * PART + 1, F.lit(PART)))

    def whole(some: Column) -> Column:
        firsts = steps(F.transform(some, lambda part: F.aggregate(part, F.lit(0), fold)), F.lit(0))
        return F.flatten(F.zip_with(some, firsts, steps))

    return _let(numbers, lambda some: _let(parts(some), whole))


def _found(text: Column, pattern: str, kind: int, least: int, value_group: int) -> Column:
    """Spans of the matches, in order, whose value has ``least`` characters at least."""
    regex = F.lit(pattern)
    between = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, regex, F.lit(0))
    value = F.regexp_extract_all(text, regex, F.lit(value_group)) if value_group else whole
    matches = F.zip_with(
        between,
        F.zip_with(whole, value, lambda w, v: F.struct(F.length(w).alias("w"), F.length(v).alias("v"))),
        lambda b, m: F.struct(F.length(b).alias("b"), m["w"].alias("w"), m["v"].alias("v")),
    )

    def placed(some: Column) -> Column:
        ends = _before(F.transform(some, lambda m: m["b"] + F.coalesce(m["w"], F.lit(0))), lambda at, n: at + n)
        spans = F.zip_with(
            some,
            ends,
            lambda m, at: F.when(
                m["v"] >= least,
                F.struct(
                    (at + m["b"]).alias("start"), (at + m["b"] + m["w"]).alias("end"), F.lit(kind).alias("kind")
                ),
            ),
        )
        return F.filter(spans, lambda s: s.isNotNull())

    return F.when(text.rlike(pattern), _let(matches, placed)).otherwise(_none())


def _of(spans: Column, kinds: tuple[str, ...]) -> Column:
    numbers = [KINDS.index(k) for k in kinds]
    return F.filter(spans, lambda s: s["kind"].isin(*numbers))


def _scopes(spans: Column) -> Column:
    """Numbers of the scopes that the spans begin in."""
    half = SCOPE // 2
    numbers = F.transform(spans, lambda s: F.floor(s["start"] / half).cast("int"))
    return F.array_distinct(F.concat(numbers, F.transform(numbers, lambda n: n - 1)))


def _steps(numbers: Column) -> Column:
    """Powers of two up to the size, the largest first."""
    largest = F.floor(F.log2(F.greatest(F.size(numbers), F.lit(1)))).cast("int")
    return F.transform(F.sequence(largest, F.lit(0), F.lit(-1)), lambda k: F.pow(F.lit(2.0), k).cast("int"))


def _up_to(numbers: Column, steps: Column, last: Column) -> Column:
    """How many of the sorted numbers are ``last`` or less, by bisection."""
    return F.aggregate(
        steps, F.lit(0), lambda at, step: at + F.when(F.get(numbers, at + step - 1) <= last, step).otherwise(0)
    )


def _within(scopes: Column, steps: Column, span: Column) -> Column:
    """Whether the span begins in one of the scopes, which are sorted."""
    last = F.floor(span["start"] / (SCOPE // 2)).cast("int")
    return F.coalesce(F.get(scopes, _up_to(scopes, steps, last) - 1) >= last - 1, F.lit(False))


def _near(starts: Column, steps: Column, span: Column) -> Column:
    """Whether one of the sorted starts is less than a scope away from that of the span."""

    def beside(n: Column) -> Column:
        before = span["start"] - F.get(starts, n - 1) < SCOPE
        return F.coalesce(before, F.lit(False)) | F.coalesce(F.get(starts, n) - span["start"] < SCOPE, F.lit(False))

    return _let(_up_to(starts, steps, span["start"]), beside)


def _linked_in_scopes(df: DataFrame) -> DataFrame:
    """Adds ``_linked``, the weak candidates in scopes in which parts that complete each other meet."""
    df = df.withColumn("_secret_scopes", _scopes(_of(F.col("_all"), SECRETS)))
    df = df.withColumn("_other_scopes", _scopes(_of(F.col("_all"), IDENTIFIERS + ENDPOINTS)))
    df = df.withColumn("_met", F.sort_array(F.array_intersect("_secret_scopes", "_other_scopes")))
    df = df.withColumn("_steps", _steps(F.col("_met")))
    return df.withColumn("_linked", F.filter("_weak", lambda s: _within(F.col("_met"), F.col("_steps"), s)))


def _linked_sliding(df: DataFrame) -> DataFrame:
    """Adds ``_linked``, the weak candidates that begin less than a scope from what completes them."""

    def near(kinds: tuple[str, ...], starts: str) -> Column:
        return F.filter(_of(F.col("_weak"), kinds), lambda s: _near(F.col(starts), F.col(f"{starts}_steps"), s))

    parts = {"_secret_starts": SECRETS, "_other_starts": IDENTIFIERS + ENDPOINTS}
    for name, kinds in parts.items():
        starts = F.transform(_of(F.col("_all"), kinds), lambda s: s["start"])
        df = df.withColumn(name, F.sort_array(F.array_distinct(starts)))
        df = df.withColumn(f"{name}_steps", _steps(F.col(name)))
    linked = near(SECRETS, "_other_starts"), near(IDENTIFIERS + ENDPOINTS, "_secret_starts")
    return df.withColumn("_linked", F.concat(*linked))


def scan(docs: DataFrame, text: str = "text", sliding: bool = False) -> DataFrame:
    """Struct ``_row`` with the columns of ``docs``, arrays ``base`` and ``spans`` of all spans.

    A span is (start, end, kind), kind being a place in ``KINDS``; arrays are ordered by that.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    df = docs.select(F.struct(*columns).alias("_row"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    t = F.col("_text")
    for kind, pattern in STRONG.items():
        df = df.withColumn(f"_{kind}", _found(t, pattern, KINDS.index(kind), LEAST[kind], 2 if kind == ASSIGN else 0))
    df = df.withColumn("base", F.array_sort(F.concat(*[f"_{kind}" for kind in STRONG])))
    for kind, pattern in WEAK.items():
        df = df.withColumn(f"_{kind}", _found(t, pattern, KINDS.index(kind), 0, 0))
    df = df.withColumn("_weak", F.concat(*[f"_{kind}" for kind in WEAK]))
    df = df.withColumn("_all", F.when(F.size("_weak") > 0, F.concat("base", "_weak")).otherwise(_none()))
    df = _linked_sliding(df) if sliding else _linked_in_scopes(df)
    spans = F.when(F.size("_linked") > 0, F.array_sort(F.concat("base", "_linked"))).otherwise(F.col("base"))
    return df.withColumn("spans", spans).select("_row", "_text", "base", "spans")


def described(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with ``MASK`` for each run of spans that overlap or touch.

    The text is cut into pieces of ``PIECE`` code points once, and what stays between the runs is
    put together from these.
    """

    def cut(pieces: Column, start: Column, end: Column) -> Column:
        first, last = (F.floor(at / PIECE).cast("int") for at in (start, end))
        return F.substring(
            F.array_join(F.slice(pieces, first + 1, last - first + 1), ""), start % PIECE + 1, end - start
        )

    def kept(some: Column) -> Column:
        furthest = _before(F.transform(some, lambda s: s["end"]), lambda at, n: F.greatest(at, n))
        gaps = F.zip_with(some, furthest, lambda s, at: F.struct(at.alias("start"), s["start"].alias("end")))
        end = F.struct(F.array_max(F.transform(some, lambda s: s["end"])).alias("start"), F.length(text).alias("end"))
        gaps = F.filter(gaps, lambda gap, k: (gap["end"] > gap["start"]) | (k == 0))
        return F.concat(gaps, F.array(end))

    whole = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    return _let(
        whole,
        lambda pieces: F.array_join(F.transform(kept(spans), lambda gap: cut(pieces, gap["start"], gap["end"])), MASK),
    )


def redact(
    docs: DataFrame, text: str = "text", length: str | None = "n_chars", sliding: bool = False
) -> DataFrame:
    """``docs`` with secrets masked, and the column ``length`` set anew where a text changed."""
    found = scan(docs, text, sliding)
    some = F.size("spans") > 0
    found = found.withColumn("_masked", F.when(some, masked(F.col("_text"), F.col("spans"))))
    row = {c: F.col("_row")[c] for c in docs.columns}
    row[text] = F.when(some, F.col("_masked")).otherwise(row[text])
    if length in row:
        kind = docs.schema[length].dataType
        row[length] = F.when(some, F.length("_masked").cast(kind)).otherwise(row[length])
    return found.select(*[c.alias(n) for n, c in row.items()])
