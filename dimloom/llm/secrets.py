"""Secret scan: fixed patterns, and strings whose sliding-window entropy is too high for prose.

Only DataFrame functions are used. A text is split by each pattern; the lengths of the gaps and of
the matches give every match its place. Candidate strings (long runs of key characters with
letters and digits) become arrays of characters. A window of ``WINDOW`` characters slides over
each, inside its row: the character that enters and the one that leaves change the sum of
c * log2(c) over the counts c, and the entropy is log2(WINDOW) - sum / WINDOW. A string is
reported if some window without an allowed part (a run, an example word, a sequence) reaches the
threshold of its character class, unless the whole string is on the allow list or overlaps a match
of the fixed patterns.

Only hits are shuffled, by document, so the work after the scan grows with the hits. Defined
results: a null or empty text has no spans; rows with null or repeated ids are scanned each; an
empty table gives no rows; texts of any length are scanned whole. Spans that tie in their start
come in the order of the kinds. Further columns, whatever their names, are not looked at. Places
count code points.
"""

from __future__ import annotations

from collections.abc import Callable
from math import log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimloom.llm.common import stored, whole

# The patterns that are asked for.
ASSIGN = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
# Both match whole runs, so asking for the length at once drops just the short runs.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"

KINDS = ("assign", "access", "hex", "entropy")
WINDOW = 20
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % WINDOW
PATTERNS = dict(zip(KINDS, (ASSIGN, ACCESS, HEX, CANDIDATE), strict=True))
# Bits a window needs, by the class of the string. Random strings of the class reach about 3.4
# and 3.9 bits in 20 characters, prose about 3.
THRESHOLDS = {"hex": 3.1, "mixed": 3.6}
# Whole strings that are long and varied but no secrets.
_TIME = r"[0-9]{4}-?[0-9]{2}-?[0-9]{2}T[0-9]{2}[0-9_+-]*Z?"
ALLOWED = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",  # UUID
    # Words and numbers, joined; possessive, as Java's engine recurses once per part otherwise.
    r"^(?:[A-Za-z]++|[0-9]{1,8}+)(?:[-_/+=]++(?:[A-Za-z]++|[0-9]{1,8}+))++$",
    rf"^{_TIME}(?:/{_TIME})?$",  # a time, or two
)
# A window with one of these does not count; the other windows of its string do. None is longer
# than a window.
ALLOWED_INSIDE = (
    r"(?<run>.)\k<run>{5}",  # runs of one character
    r"(?i:example|sample|dummy|placeholder|changeme|redacted)",
    r"(?i:0123456789|123456789|abcdefghij|qwertyuiop)",
)


def hits_of(text: Column, kind: str) -> Column:
    """Array of (kind, nth, gap, value): each match and the characters since the one before."""
    pattern = PATTERNS[kind]
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)

    def hit(pair: Column, nth: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"),
            nth.alias("nth"),
            pair["gap"].alias("gap"),
            pair["value"].alias("value"),
        )

    pairs = F.arrays_zip(gaps.alias("gap"), values.alias("value"))
    return F.when(
        text.rlike(pattern), F.filter(F.transform(pairs, hit), lambda h: h["value"].isNotNull())
    )


def placed(hits: DataFrame) -> DataFrame:
    """Hits with their start and end instead of the gaps."""
    so_far = Window.partitionBy("row", "kind").orderBy("nth")
    end = F.sum(F.col("gap") + F.length("value")).over(
        so_far.rowsBetween(Window.unboundedPreceding, 0)
    )
    return hits.withColumn("end", end).withColumn("start", F.col("end") - F.length("value"))


def base_hits(hits: DataFrame) -> DataFrame:
    """Hits of the fixed patterns that pass; only assigned values may still be too short."""
    value_length = F.length(F.regexp_extract("value", ASSIGN, 1))
    return hits.where("kind in ('access', 'hex')").unionByName(
        hits.where(F.col("kind") == "assign").where(value_length >= 8)
    )


def matches_any(value: Column, patterns: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for pattern in patterns:
        found = found | value.rlike(pattern)
    return found


def allowed_lengths(value: Column) -> Column:
    """For each character, the length of the allowed part that starts there, or 0.

    The string is cut before every allowed part, also where parts overlap.
    """
    ahead = "|".join(ALLOWED_INSIDE)
    parts = F.transform(F.regexp_extract_all(value, F.lit(f"(?=({ahead}))"), F.lit(1)), F.length)
    pieces = F.transform(F.split(value, f"(?={ahead})", -1), F.length)
    # A part at the very start has no piece before it.
    starts = F.concat(F.array_repeat(F.lit(0), F.size(pieces) - F.size(parts)), parts)

    def spread(piece: Column, part: Column) -> Column:
        return F.concat(F.array(part), F.array_repeat(F.lit(0), piece - 1))

    return F.flatten(F.zip_with(pieces, starts, spread))


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def changes_of_sum(chars: Column, window: Callable[[Column], Column]) -> Column:
    """What each character adds to the sum of c * log2(c), by its own count in a window."""

    def change(count: int) -> float:
        return count * log2(count) - (count > 1 and (count - 1) * log2(count - 1))

    changes = F.array(*(F.lit(float(change(count))) for count in range(1, WINDOW + 1)))

    def changed(char: Column, at: Column) -> Column:
        return F.element_at(changes, F.size(F.filter(window(at), lambda other: other == char)))

    return F.transform(chars, changed)


def most_in_windows(gains: Column, losses: Column, lengths: Column) -> Column:
    """Slides the window: a character enters with its gain, another leaves with its loss."""

    def counts(nth: Column) -> Column:
        """If no allowed part lies in the window that starts there."""
        inside = F.filter(
            F.slice(lengths, nth + 1, WINDOW), lambda part, i: (part > 0) & (i + part <= WINDOW)
        )
        return F.coalesce(F.size(inside) == 0, F.lit(True))

    def state(total: Column, best: Column, nth: Column) -> Column:
        entropy = F.lit(log2(WINDOW)) - total / WINDOW
        better = F.when(counts(nth), F.greatest(best, entropy)).otherwise(best)
        return F.struct(total.alias("total"), better.alias("best"), (nth + 1).alias("nth"))

    first = F.aggregate(F.slice(gains, 1, WINDOW), F.lit(0.0), lambda total, gain: total + gain)
    steps = F.zip_with(
        F.slice(gains, WINDOW + 1, F.size(gains)),
        F.slice(losses, 1, F.size(losses) - WINDOW),
        lambda gain, loss: gain - loss,
    )
    return F.aggregate(
        steps,
        state(first, F.lit(None).cast("double"), F.lit(0)),
        lambda at, step: state(at["total"] + step, at["best"], at["nth"]),
    )["best"]


def most_entropy(value: Column) -> Column:
    """The largest entropy of a window without an allowed part; null if there is none."""
    lengths = F.when(matches_any(value, ALLOWED_INSIDE), allowed_lengths(value))

    def of_characters(chars: Column) -> Column:
        def until(at: Column) -> Column:
            start = F.greatest(at + (2 - WINDOW), F.lit(1))
            return F.slice(chars, start, F.least(at + 1, F.lit(WINDOW)))

        def ahead(at: Column) -> Column:
            return F.slice(chars, at + 1, F.lit(WINDOW))

        return let(
            F.struct(
                changes_of_sum(chars, until).alias("gains"),
                changes_of_sum(chars, ahead).alias("losses"),
                lengths.alias("lengths"),
            ),
            lambda each: most_in_windows(each["gains"], each["losses"], each["lengths"]),
        )

    return let(F.split(value, "(?!^|$)"), of_characters)


def high_entropy(candidates: DataFrame) -> DataFrame:
    """Candidates (row, start, end, value) with a window of enough entropy and no allowed part."""
    allowed = matches_any(F.col("value"), ALLOWED)
    varied = F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]")
    chosen = candidates.where(varied & ~allowed)
    is_hex = F.col("value").rlike("^[0-9a-fA-F]+$")
    needed = F.when(is_hex, THRESHOLDS["hex"]).otherwise(THRESHOLDS["mixed"])
    return chosen.where(most_entropy(F.col("value")) >= needed).select(
        "row", F.lit("entropy").alias("kind"), "start", "end"
    )


def apart_from_base(spans: DataFrame) -> DataFrame:
    """Without the entropy spans that overlap a base span of their document."""
    is_base = F.col("kind") != "entropy"
    order = Window.partitionBy("row").orderBy("start", "end", "kind")
    reached = F.max(F.when(is_base, F.col("end"))).over(
        order.rowsBetween(Window.unboundedPreceding, 0)
    )
    following = F.min(F.when(is_base, F.col("start"))).over(
        order.rowsBetween(0, Window.unboundedFollowing)
    )
    overlaps = (F.coalesce(reached, F.lit(0)) > F.col("start")) | (
        F.coalesce(following, F.col("end")) < F.col("end")
    )
    return spans.withColumn("_overlaps", overlaps).where(is_base | ~F.col("_overlaps"))


def told(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of every row.

    The counts and the digest are of the fixed patterns; ``spans`` also has the others.
    """
    scanned = stored(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("doc_id"),
            F.array_compact(
                F.flatten(
                    F.array(*(F.coalesce(hits_of(whole(text), k), F.array()) for k in KINDS))
                )
            ).alias("hits"),
        ),
        "hits",
    )
    found = scanned.where(F.size("hits") > 0).select("row", F.explode("hits").alias("hit"))
    hits = placed(found.select("row", "hit.*"))
    candidates = hits.where(F.col("kind") == "entropy").select("row", "start", "end", "value")
    spans = apart_from_base(
        base_hits(hits).select("row", "kind", "start", "end").unionByName(high_entropy(candidates))
    )
    order = F.array_position(F.array(*(F.lit(k) for k in KINDS)), F.col("kind"))
    by_document = spans.groupBy("row").agg(
        *(F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in KINDS[:3]),
        F.sort_array(
            F.collect_list(F.struct("start", order.alias("order"), "end", "kind"))
        ).alias("spans"),
    )
    base = F.filter("spans", lambda s: s["kind"] != "entropy")
    results = by_document.select(
        "row",
        *(f"n_{k}" for k in KINDS[:3]),
        told(base).alias("base"),
        told(F.col("spans")).alias("spans"),
    )
    no_spans = F.lit("")
    return scanned.select("row", "doc_id").join(results, "row", "left").select(
        "doc_id",
        *(F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(F.coalesce("base", no_spans).cast("binary"), 256).alias("base_sha256"),
        F.coalesce("spans", no_spans).alias("spans"),
    )
