"""Secrets in whole texts: three fixed patterns, and strings of high entropy.

Everything is Spark SQL.  A text is split at its matches, so that running sums of the lengths of gaps and matches give
each span in code points; sums are made in lots of LOT matches, so a text with very many takes time in proportion.  Then
the base matches and rulers are blanked, kind by kind, and what is left of key-like runs is judged run by run: entropy is
followed along a window by counts that change by one character in and one out.

Rows: a NULL or empty text has no spans; repeated rows and ties give the same spans each; extra columns stay as they
are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns, the group that is measured and its least length, in the order of the kinds.
KEYWORDS = "password|passwd|secret|token|api_?key"
BASE = {
    "assign": (r"""({keywords})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": ("AKIA[A-Z0-9]+", 0, 20),
    "hex": ("[0-9a-f]{24,}", 0, 24),  # runs are maximal, so shorter ones need not be matched first
}
# What entropy looks at: key-like runs between '=', base matches and rulers, judged by the narrowest class that holds the run.
RUN = "[A-Za-z0-9+/_-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
WINDOW = 20
CLASSES = [("^[0-9A-Fa-f]+$", 3.0), ("^[0-9A-Za-z]+$", 3.6), ("", 3.8)]  # bits per character that a window must reach
UUID = "[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}"
ALLOWED = ["^[0-9]+$", "^[A-Za-z]+$", "(?i)example|sample|placeholder|dummy|x{6}|0123456789|abcdefgh", f"^{UUID}$"]
RULER = r"/{4,}|_{4,}|\+{4,}|-{4,}"
# A run that '=' follows may be the name of a value, and one with these signs a path: both are allowed if they consist of words.
PATH_LIKE = "^[/_+-]|//|--"
PATH_PART = "^(?:[A-Z]?[a-z]+(?:[A-Z][a-z]+){0,8}[0-9]{0,4}|[A-Z]+[0-9]{0,4}|[0-9]+)?$"
LONGEST_PART = 40
LOT = 512
KINDS = [*BASE, "entropy"]
SPAN = "array<struct<start:int,k:int,end:int>>"


def any_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


def pattern(kind: str) -> str:
    return BASE[kind][0].replace("{keywords}", any_case(KEYWORDS))


def bound(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, however often it is looked at."""
    return F.transform(F.array(value), use)[0]


def located(text: Column, regex: str, kind: int) -> Column:
    """Spans of all leftmost, non-overlapping matches."""
    none = F.array().cast(SPAN)
    matched = F.struct(F.regexp_extract_all(text, F.lit(regex), F.lit(0)).alias("hits"), F.split(text, regex, -1).alias("gaps"))

    def sized(m: Column) -> Column:
        return F.zip_with(F.slice(m.gaps, F.lit(1), F.size(m.hits)), m.hits, lambda gap, hit: F.struct(
            F.length(gap).alias("gap"), F.length(hit).alias("hit")))

    def lots(steps: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / LOT).cast("int")), lambda i: F.slice(steps, i * LOT + 1, LOT))

    def placed(parts: Column) -> Column:
        begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<at:int,lot:array<struct<gap:int,hit:int>>>>").alias("out"))
        return F.aggregate(parts, begin, lambda acc, lot: F.struct(
            F.aggregate(lot, acc.at, lambda sum_, s: sum_ + s.gap + s.hit).alias("at"),
            F.concat(acc.out, F.array(F.struct(acc.at.alias("at"), lot.alias("lot")))).alias("out")), lambda acc: acc.out)

    def spans(part: Column) -> Column:
        begin = F.struct(part.at.alias("at"), none.alias("out"))
        return F.aggregate(part.lot, begin, lambda acc, s: F.struct(
            (acc.at + s.gap + s.hit).alias("at"),
            F.concat(acc.out, F.array(F.struct((acc.at + s.gap).alias("start"), F.lit(kind).alias("k"),
                                               (acc.at + s.gap + s.hit).alias("end")))).alias("out")), lambda acc: acc.out)

    whole = bound(matched, lambda m: bound(sized(m), lambda steps: F.when(F.size(steps) > 0, F.flatten(
        F.transform(placed(lots(steps)), spans))).otherwise(none)))
    return F.when(text.rlike(regex), whole).otherwise(none)


def blanked(text: Column, regex: str, group: int = 0, least: int = 0) -> Column:
    """The text with blanks in place of its matches, those whose group is long enough."""
    matched = F.struct(F.regexp_extract_all(text, F.lit(regex), F.lit(0)).alias("hits"), F.split(text, regex, -1).alias("gaps"),
                       F.regexp_extract_all(text, F.lit(regex), F.lit(group)).alias("values"))

    def covered(m: Column) -> Column:
        marks = F.zip_with(m.hits, m["values"], lambda hit, value: F.when(
            F.length(value) >= least, F.repeat(F.lit(" "), F.length(hit))).otherwise(hit))
        return F.array_join(F.zip_with(m.gaps, marks, lambda gap, mark: F.concat(gap, F.coalesce(mark, F.lit("")))), "")

    return F.when(text.rlike(regex), bound(matched, covered)).otherwise(text)


def base_spans(text: Column, kind: str) -> Column:
    """The spans of a base kind that are long enough."""
    _, group, least = BASE[kind]
    regex = pattern(kind)
    spans = located(text, regex, list(BASE).index(kind))
    measured = F.regexp_extract_all(text, F.lit(regex), F.lit(group))
    kept = F.zip_with(spans, measured, lambda s, m: F.when(F.length(m) >= least, s))
    return F.when(text.rlike(regex), F.filter(kept, lambda s: s.isNotNull())).otherwise(F.array().cast(SPAN))


def _weight(count: Column) -> Column:
    return F.when(count > 1, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))


def peak_entropy(run: Column) -> Column:
    """The largest Shannon entropy of any window of WINDOW characters, from counts that follow the window."""
    code = F.transform(F.split(run, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    code = F.filter(code, lambda c: c >= 0)
    none = F.array_repeat(F.lit(0), len(ALPHABET))

    def step(acc: Column, i: Column) -> Column:
        enters = acc.code[i]
        leaves = F.when(i >= WINDOW, acc.code[i - WINDOW]).otherwise(F.lit(-1))
        moved = F.when(enters == leaves, F.lit(0)).otherwise(F.lit(1))
        into = acc.counts[enters]
        gain = F.when(moved == 1, _weight(into + 1) - _weight(into)).otherwise(F.lit(0.0))
        out = F.when((moved == 1) & (leaves >= 0), acc.counts[F.greatest(leaves, F.lit(0))])
        loss = F.when(out.isNotNull(), _weight(out) - _weight(out - 1)).otherwise(F.lit(0.0))
        total = acc.total + gain - loss
        counts = F.transform(acc.counts, lambda v, j: v + F.when(moved == 0, 0).when(j == enters, 1)
                             .when(j == leaves, -1).otherwise(0))
        bits = F.lit(WINDOW).cast("double")
        entropy = F.when(i >= WINDOW - 1, F.log2(bits) - total / bits).otherwise(F.lit(0.0))
        return F.struct(acc.code.alias("code"), counts.alias("counts"), total.alias("total"),
                        F.greatest(acc.peak, entropy).alias("peak"))

    zero = F.struct(code.alias("code"), none.alias("counts"), F.lit(0.0).alias("total"), F.lit(0.0).alias("peak"))
    return F.aggregate(F.sequence(F.lit(0), F.length(run) - 1), zero, step, lambda acc: acc.peak)


def of_words(run: Column) -> Column:
    """Whether a run consists of words, numbers and UUIDs between '/', '_', '+' and '-', as paths and names do."""
    parts = F.split(F.regexp_replace(run, UUID, ""), "[/_+-]+")
    return F.forall(parts, lambda part: (F.length(part) <= LONGEST_PART) & part.rlike(PATH_PART))


def looks_random(run: Column, named: Column) -> Column:
    """Whether some window of the run is as varied as its character class asks for, and nothing allows the run.

    ``named``: whether '=' follows, so that the run may be the name of a value.
    """
    least = F.lit(CLASSES[-1][1])
    for regex, bits in reversed(CLASSES[:-1]):
        least = F.when(run.rlike(regex), F.lit(bits)).otherwise(least)
    allowed = F.lit(False)
    for regex in ALLOWED:
        allowed = allowed | run.rlike(regex)
    allowed = allowed | ((named | run.rlike(PATH_LIKE)) & of_words(run))
    return F.when(allowed, F.lit(False)).otherwise(F.round(peak_entropy(run), 9) >= least)


def entropy_spans(rest: Column) -> Column:
    """Spans of the runs that look random in a text without its base matches and rulers."""
    runs = F.regexp_extract_all(rest, F.lit(RUN), F.lit(0))
    after = F.slice(F.split(rest, RUN, -1), F.lit(2), F.size(runs))
    found = F.zip_with(runs, after, lambda run, gap: looks_random(run, gap.startswith("=")))
    spans = F.zip_with(located(rest, RUN, KINDS.index("entropy")), found, lambda s, fine: F.when(fine, s))
    return F.when(rest.rlike(RUN), F.filter(spans, lambda s: s.isNotNull())).otherwise(F.array().cast(SPAN))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, by start and kind, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", names[s.k], s.start.cast("string"), s.end.cast("string"))), ",")


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """row (all columns of a row as a struct), whole (its text) and found: all spans by start, as (start, k, end) with
    k the place of the kind in KINDS."""
    docs = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text}`").alias("whole"))
    whole = F.coalesce("whole", F.lit(""))
    for kind in BASE:
        docs = docs.withColumn(f"_{kind}", base_spans(whole, kind))
    rest = whole
    for kind, (_, group, least) in BASE.items():
        rest = blanked(rest, pattern(kind), group, least)
        docs = docs.withColumn("rest", rest)
        rest = F.col("rest")
    docs = docs.withColumn("rest", blanked(rest, RULER))
    docs = docs.withColumn("found", F.array_sort(F.concat(*[F.col(f"_{kind}") for kind in BASE], entropy_spans(F.col("rest")))))
    return docs.select("row", "whole", "found")


def merged(spans: Column) -> Column:
    """Sorted spans as lots of intervals that do not overlap, with the end of the lot before."""
    lots = F.transform(F.sequence(F.lit(0), F.floor((F.size(spans) - 1) / LOT).cast("int")), lambda i: F.slice(spans, i * LOT + 1, LOT))
    kind = "array<struct<start:int,end:int>>"
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<struct<at:int,all:{kind},end:int>>").alias("out"))

    def lot(acc: Column, part: Column) -> Column:
        start = F.struct(acc.at.alias("at"), F.array().cast(kind).alias("out"))
        inner = F.aggregate(part, start, lambda a, s: F.when(s.end <= a.at, a).otherwise(F.struct(
            s.end.alias("at"), F.concat(a.out, F.array(F.struct(F.greatest(s.start, a.at).alias("start"), s.end.alias("end")))).alias("out"))))
        return bound(inner, lambda x: F.struct(x.at.alias("at"), F.concat(acc.out, F.array(F.struct(
            acc.at.alias("at"), x.out.alias("all"), x.at.alias("end")))).alias("out")))

    return F.aggregate(lots, begin, lot, lambda acc: acc.out)


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The same rows with every span of the text replaced by a mark; what two spans share gets the mark of the first."""
    whole = F.col("whole")

    def cleaned(part: Column) -> Column:
        """The text of a lot, from the end of the one before: cut out once, then cut at its intervals."""
        piece = F.substring(whole, part.at + 1, part.end - part.at)
        return bound(piece, lambda body: F.aggregate(
            part.all, F.struct(part.at.alias("at"), F.array().cast("array<string>").alias("out")), lambda acc, s: F.struct(
                s.end.alias("at"), F.concat(acc.out, F.array(
                    F.substring(body, acc.at - part.at + 1, s.start - acc.at),
                    F.when((s.start > acc.at) | (acc.at == 0), F.lit(mark)).otherwise(F.lit("")))).alias("out")),
            lambda acc: F.array_join(acc.out, "")))

    parts = bound(merged(F.col("found")), lambda lots: F.concat(
        F.array_join(F.transform(lots, cleaned), ""), F.substring(whole, F.element_at(lots, -1).end + 1, F.length(whole))))
    out = F.when(F.size("found") > 0, parts).otherwise(whole)
    return scan(docs, text).select(*[(out if c == text else F.col("row").getField(c)).alias(c) for c in docs.columns])


def of_kind(kind: int):
    return lambda span: span.k == kind


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_assign, n_access, n_hex, base_sha256, spans, n_entropy."""
    docs = scan(docs.select(key, text), text)
    count = {k: F.size(F.filter("found", of_kind(i))).cast("long") for i, k in enumerate(KINDS)}
    base = F.filter("found", lambda s: s.k < len(BASE))
    return docs.select(F.col("row").getField(key).alias(key), *[count[k].alias(f"n_{k}") for k in BASE], F.sha2(listed(base), 256).alias("base_sha256"),
                       listed(F.col("found")).alias("spans"), count["entropy"].alias("n_entropy"))
