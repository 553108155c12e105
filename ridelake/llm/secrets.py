"""Operator 9: secret scan, in DataFrame functions alone.

Three base kinds are found by pattern, leftmost first and without overlap:
``assign`` (a password-like name, a sign, a value), ``access`` (access key
ids) and ``hex`` (long hexadecimal runs). Matches that are too short are
dropped after matching, so they still take up their place.

The method adds ``entropy`` spans. Candidate strings are runs of a character class:
hexadecimal digits, letters and digits, or the whole base-64 alphabet with its signs;
each class has its least length, the kinds of character a run must hold, a window and
a threshold (``CLASSES``). The window slides over a candidate; the counts of the
characters in it are kept incrementally (one goes up, one goes down, ten of them packed
into a number), and with them the sum of ``c * log2(c)``, from which the window's Shannon
entropy follows in one step. A candidate of which any window reaches its class's threshold
is reported, unless a base span already covers it. The allow list works window by
window: a window that touches one of ``ALLOWED`` words doesn't count, the others of the
candidate do; digests that are named as such are no candidates.

Positions: the pieces between the matches of a pattern (``split``) and the
matches themselves (``regexp_extract_all``) alternate, so their lengths, summed,
are the spans in code points.

Defined results: null and empty text have no spans; ties in start are ordered
by kind (assign, access, hex, entropy); every row is answered on its own, so
repeated rows and null ids are answered too.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns and least lengths of the contract. A run of a
# class is always matched as a whole, so for ``access`` and ``hex`` the least
# length stands in the pattern; short ``assign`` values are dropped afterwards,
# because a match that fails there still hides what it covers.
ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_LEAST = 8
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"

# Letters and digits that a word, a UUID, a date or a named digest (sha256-...) is not made of.
_NAMED = r"(?<!(?:sha1|sha224|sha256|sha384|sha512|md5)[-_=:])"
# by class: pattern of a run, kinds of character it must hold (letters alone must change case more
# than a capitalised word does), window, least bits a character
CLASSES = {
    "hex_run": (r"(?<![A-Za-z0-9])(?=[0-9a-fA-F]{20})" + _NAMED + r"[0-9a-fA-F]{20,}(?![A-Za-z0-9])", ("[0-9]", "[a-fA-F]"), 20, 3.0),
    "mixed_run": (r"(?<![A-Za-z0-9])(?=[A-Za-z0-9]{20})" + _NAMED + r"[A-Za-z0-9]{20,}", ("[g-zG-Z]", "[0-9]|[a-z][A-Z].*[A-Z]"), 20, 3.9),
    "signed_run": (r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{32,}", ("[+/_=-]", "[0-9]", "[a-z]", "[A-Z]"), 32, 4.3),
}
ALLOWED = "(?i)example|placeholder|changeme"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_PACKED, _BITS = 10, 6  # counts to a number, and bits to a count: windows of up to 63 characters
KINDS = ("assign", "access", "hex", "entropy")


def _starts(df: DataFrame, name: str, pattern: str) -> DataFrame:
    """Adds ``name``: array<struct<start, end, value, second>> of a pattern's matches."""
    found, other, gaps, at = (f"{name}_{x}" for x in ("found", "other", "gaps", "at"))
    none = F.array().cast("array<string>")
    df = df.withColumn(found, F.regexp_extract_all("body", F.lit(pattern), F.lit(0)))
    some = F.size(found) > 0
    group = F.regexp_extract_all("body", F.lit(pattern), F.lit(2)) if name == "assign" else F.col(found)
    df = df.withColumns({
        other: F.when(some, group).otherwise(none),
        gaps: F.when(some, F.transform(F.split("body", pattern, -1), F.length)).otherwise(F.array().cast("array<int>"))})
    # the end of each match: all gaps and matches up to it
    df = df.withColumn(at, F.aggregate(
        F.zip_with(F.slice(gaps, 1, F.size(found)), F.transform(found, F.length),
                   lambda gap, size: F.struct(gap.alias("gap"), size.alias("size"))),
        F.struct(F.lit(0).alias("end"), F.array().cast("array<int>").alias("ends")),
        lambda acc, x: F.struct((acc["end"] + x["gap"] + x["size"]).alias("end"),
                                F.concat(acc["ends"], F.array(acc["end"] + x["gap"] + x["size"])).alias("ends")),
        lambda acc: acc["ends"]))
    spans = F.zip_with(
        at, F.arrays_zip(F.col(found).alias("value"), F.col(other).alias("second")),
        lambda end, m: F.struct((end - F.length(m["value"])).alias("start"), end.alias("end"),
                                m["value"].alias("value"), m["second"].alias("second")))
    return df.withColumn(name, spans).drop(found, other, gaps, at)


def best_entropy(value: Column, window: int) -> Column:
    """Largest entropy (bits a character) in a window sliding over ``value``.

    The state holds the counts of the alphabet's characters, packed, and the sum of
    count * log2(count); a step changes two counts and that sum. A value
    shorter than the window has minus infinity.
    """
    def term(count: Column) -> Column:
        return F.when(count > 1, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))

    def count_of(counts: Column, place: Column) -> Column:
        packed = F.get(counts, (place / _PACKED).cast("int"))
        return F.call_function("shiftright", packed, (place % _PACKED * _BITS).cast("int")).bitwiseAND(F.lit(2 ** _BITS - 1))

    def one(j: Column, place: Column) -> Column:
        return F.when((place / _PACKED).cast("int") == j, F.call_function(
            "shiftleft", F.lit(1).cast("long"), (place % _PACKED * _BITS).cast("int"))).otherwise(F.lit(0).cast("long"))

    # the places in the alphabet (from 0), found once: a lambda's argument isn't computed again
    def steps(places: Column) -> Column:
        return F.transform(places, lambda p, i: F.struct(
            p.alias("enters"), F.when(i >= window, F.get(places, i - window)).otherwise(F.lit(-1)).alias("leaves"),
            (i + 1).alias("n")))

    found = F.array(F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1))
    numbers = -(-len(ALPHABET) // _PACKED)
    start = F.struct(F.array_repeat(F.lit(0).cast("long"), numbers).alias("counts"), F.lit(0.0).alias("sum"),
                     F.lit(float("inf")).cast("double").alias("least"))

    def step(acc: Column, s: Column) -> Column:
        enters, leaves = s["enters"], s["leaves"]
        up, down = count_of(acc["counts"], enters), count_of(acc["counts"], F.greatest(leaves, F.lit(0)))
        total = F.when(enters == leaves, acc["sum"]).otherwise(
            acc["sum"] + term(up + 1) - term(up)
            + F.when(leaves >= 0, term(down - 1) - term(down)).otherwise(F.lit(0.0)))
        counts = F.transform(acc["counts"], lambda c, j: c + one(j, enters)
                             - F.when(leaves >= 0, one(j, leaves)).otherwise(F.lit(0).cast("long")))
        return F.struct(counts.alias("counts"), total.alias("sum"),
                        F.when(s["n"] >= window, F.least(acc["least"], total)).otherwise(acc["least"]).alias("least"))

    return F.get(F.transform(found, lambda places: F.aggregate(
        steps(places), start, step, lambda acc: F.log2(F.lit(float(window))) - acc["least"] / F.lit(float(window)))), F.lit(0))


def _of_kind(name: str, keep: Callable[[Column], Column] | None = None, order: int | None = None) -> Column:
    spans = F.col(name) if keep is None else F.filter(name, keep)
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(KINDS.index(name) if order is None else order).alias("order"), s["end"].alias("end")))


def _written(spans: Column) -> Column:
    """kind:start:end of sorted spans, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["order"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan_secrets(docs: DataFrame, classes: dict[str, tuple] | None = None) -> DataFrame:
    """One row per document with its spans: ``base`` and ``all_spans`` are
    array<struct<start, order, end>>, ``order`` the place in ``KINDS``."""
    classes = classes or CLASSES
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                     F.coalesce(F.col("text").cast("string"), F.lit("")).alias("body"))
    for name, pattern in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), *((n, c[0]) for n, c in classes.items())):
        df = _starts(df, name, pattern)
    df = df.drop("body").withColumn(
        "base", F.array_sort(F.concat(
            _of_kind("assign", lambda s: F.length(s["second"]) >= ASSIGN_LEAST), _of_kind("access"), _of_kind("hex"))))
    for name, (_, kinds, window, bits) in classes.items():
        # cheap tests first: the window slides over what they leave
        df = df.withColumn(name, F.filter(name, _holds(kinds)))
        df = df.withColumn(name, F.filter(name, _reaches(window, bits)))
    return df.select("doc_id", "base", F.array_sort(F.array_distinct(F.concat(
        "base", *[_of_kind(n, order=KINDS.index("entropy")) for n in classes]))).alias("all_spans"))


def _holds(kinds: tuple[str, ...]) -> Callable[[Column], Column]:
    """Whether a candidate has all ``kinds`` of characters and no base span covers it."""
    def test(s: Column) -> Column:
        found = ~F.exists("base", lambda b: (b["start"] <= s["start"]) & (b["end"] >= s["end"]))
        for kind in kinds:
            found = s["value"].rlike(kind) & found
        return found
    return test


def _reaches(window: int, bits: float) -> Callable[[Column], Column]:
    """Whether a window of a candidate that touches no allowed word reaches ``bits``."""
    return lambda s: F.exists(F.filter(F.split(s["value"], ALLOWED), lambda part: F.length(part) >= window),
                              lambda part: best_entropy(part, window) >= bits)


def secret_report(docs: DataFrame) -> DataFrame:
    """Counts and digests of the spans of every document."""
    found = scan_secrets(docs)
    count = lambda order: F.size(F.filter("base", lambda s: s["order"] == order)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"), _written(F.col("all_spans")).alias("spans"))
