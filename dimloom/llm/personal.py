"""Personal data: fixed patterns, and contextual patterns bootstrapped from what they find.

The identifiers that the fixed patterns find are the seeds. A contextual pattern is the two words
or the one before an identifier, or the one after it. Patterns and the tokens beside them form a
graph: seeds have score 1, and what else has the shape of one (tokens with digits, groups of digits,
addresses in words) starts at 0; a pattern's confidence for a kind is the mean score of its distinct
tokens, and a token takes the best confidence of its patterns. A pattern counts if it precedes
enough distinct known identifiers of one kind, if its confidence is high, and if the words precede
little else: for that, all documents are scanned once for the words of every pattern that could
come to count. Tokens found so are known in the next round; rounds go on until none finds a new
pattern. Tokens that a counted pattern precedes are reported as spans of its kind.

Every statistic is over all documents and aggregated by Spark; patterns that may count are
broadcast in blocks of bounded size, one scan a block.

Defined results: a null or empty text has no spans; rows with null or repeated ids are scanned
each; an empty table gives no rows; texts of any length are scanned whole; further columns,
whatever their names, are kept by ``masked`` and otherwise not looked at. Of patterns that tie in
confidence the kind listed last names a token. Places count code points.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimloom.llm.common import in_small_batches, prepare, stored, whole
from dimloom.llm.words import class_table, mixed, word_hashes

KINDS = ("email", "ip", "card", "phone")
# The patterns that are asked for. An email's local part is looked for leftwards
# from the sign, so that words without it cost nothing; a number starts where its digits do.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# Unknown identifiers are looked for in three shapes: tokens with so many digits in a row, which may
# be of any kind, groups of digits, which may be phones or cards, and addresses in words.
_DIGITS = re.compile(r"[0-9]{4,}")
_TOKEN_END = re.compile(r"[\s,;:()\"'<>]")
_GROUPS = re.compile(r"(?<![0-9A-Za-z])[(+]{0,2}[0-9]+(?:[ ()./-]{1,3}[0-9]+)*")
_GROUP = re.compile(r"[0-9]+")
GROUP_DIGITS = (5, 19)
_AT = re.compile(r"\s?(?:[\[(]\s?at\s?[\])]|(?<=\s)at(?=\s)|@)\s?", re.I)
_SPELT = re.compile(
    r"[A-Za-z0-9-]+(?:(?:\.|\s?[\[(]\s?dot\s?[\])]\s?|\sdot\s)[A-Za-z0-9-]+)+", re.I
)
TOKEN, GROUPED, SPELT = -1, -2, -3
FITS = {TOKEN: (0, 1, 2, 3), GROUPED: (2, 3), SPELT: (0,)}

CLASSES = class_table(bytes(b for b in range(128) if not chr(b).isalnum()))
_PAIR = np.uint64(0xD6E8FEB86659FD93)
_LEFT, _RIGHT = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)

LEAST_KNOWN = 5  # distinct known identifiers a pattern precedes
LEAST_CONFIDENCE = 0.8
LEAST_SHARE = 0.5  # of all places of its words, those before an identifier or candidate
BLOCK = 500_000  # patterns broadcast for one scan


def passes_luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Start, number of the kind and end of every identifier, in order."""
    spans = []
    reached, sign = 0, text.find("@")
    while sign >= 0:
        start = sign
        while start > reached and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, sign + 1) if start < sign else None
        if domain:
            reached = domain.end()
            spans.append((start, 0, reached))
        sign = text.find("@", max(sign + 1, reached))
    if _DIGIT.search(text):
        for match in _IP.finditer(text):
            parts = (part.lstrip("0") for part in match.group().split("."))
            if all(len(part) <= 3 and int(part or 0) <= 255 for part in parts):
                spans.append((match.start(), 1, match.end()))
        for match in _CARD.finditer(text):
            if match.end() - match.start() >= 14:
                digits = match.group().replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and passes_luhn(digits):
                    spans.append((match.start(), 2, match.end()))
        for match in _PHONE.finditer(text):
            if 10 <= len(_DIGIT.findall(match.group())) <= 15:
                spans.append((match.start(), 3, match.end()))
        spans.sort()
    return spans


def candidate_tokens(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Start, shape and end of what may be an identifier and no base span touches."""
    found, reached = set(), 0
    for match in _DIGITS.finditer(text):
        if match.start() < reached:
            continue
        start, end = match.span()
        while start > reached and not _TOKEN_END.match(text, start - 1):
            start -= 1
        following = _TOKEN_END.search(text, end)
        end = following.start() if following else len(text)
        reached = end
        while end > match.end() and text[end - 1] in ".?!-":
            end -= 1
        found.add((start, TOKEN, end))
    gap = 0
    for before, _, after in [*spans, (len(text), 0, len(text))]:
        if gap < before:
            found.update(digit_groups(text, gap, before))
        gap = max(gap, after)
    found.update(spelt_addresses(text))
    tokens = {(start, end) for start, shape, end in found if shape == TOKEN}
    merged: list[list[int]] = []
    for start, _, end in spans:
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    ends = [end for _, end in merged]
    result = []
    for start, shape, end in sorted(found):
        at = bisect_right(ends, start)
        touched = at < len(merged) and merged[at][0] < end
        if not touched and (shape == TOKEN or (start, end) not in tokens):
            result.append((start, shape, end))
    return result


def digit_groups(text: str, begin: int, stop: int) -> Iterator[tuple[int, int, int]]:
    """Neighbouring groups of digits between two places, as many as an identifier may have."""
    for match in _GROUPS.finditer(text, begin, stop):
        start, end, digits = match.start(), match.start(), 0
        for group in _GROUP.finditer(text, match.start(), match.end()):
            size = group.end() - group.start()
            if digits and digits + size > GROUP_DIGITS[1]:
                if digits >= GROUP_DIGITS[0]:
                    yield start, GROUPED, end
                start, digits = group.start(), 0
            end, digits = group.end(), digits + size
        if GROUP_DIGITS[0] <= digits <= GROUP_DIGITS[1]:
            yield start, GROUPED, end


def spelt_addresses(text: str) -> Iterator[tuple[int, int, int]]:
    """Addresses with the sign or the dots in words."""
    reached = 0
    for sign in _AT.finditer(text):
        domain = _SPELT.match(text, sign.end())
        start = sign.start()
        while domain and start > reached:
            if text[start - 1] in _LOCAL:
                start -= 1
            elif start < sign.start() and text[max(reached, start - 5) : start].lower() == " dot ":
                start -= 5
            else:
                break
        if domain and start < sign.start() and text[start] in _LOCAL:
            yield start, SPELT, domain.end()
            reached = domain.end()


def all_contexts(texts: list[bytes]) -> np.ndarray:
    """Hashes of the contexts that the words of the texts are: every two neighbouring words and
    every word before a place, and every word after one."""
    hashes, first = word_hashes(texts, CLASSES)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    pairs = mixed(hashes[:-1] * _PAIR + hashes[1:])[owner[:-1] == owner[1:]]
    return np.concatenate([pairs, mixed(hashes * _LEFT), mixed(hashes * _RIGHT)]).view(np.int64)


def contexts(texts: list[str], places: list[tuple[int, int, int]]) -> list[list[int]]:
    """Hashes of the two words and the one before each (text, start, end), and of the one after."""
    result: list[list[int]] = [[] for _ in places]
    by_text: dict[int, list[int]] = {}
    for i, (t, _, _) in enumerate(places):
        by_text.setdefault(t, []).append(i)
    encoded = [texts[t].encode() for t in by_text]
    hashes, first = word_hashes(encoded, CLASSES)
    with np.errstate(over="ignore"):
        pairs = mixed(hashes[:-1] * _PAIR + hashes[1:]).view(np.int64)
        left, right = (mixed(hashes * f).view(np.int64) for f in (_LEFT, _RIGHT))
    for nth, (t, some) in enumerate(by_text.items()):
        text, blob = texts[t], np.frombuffer(encoded[nth], dtype=np.uint8)
        edges = np.flatnonzero(np.diff(np.r_[False, CLASSES[blob] != 0, False].view(np.int8)))
        places_in = np.array([places[i][1:] for i in some])
        if len(blob) > len(text):  # places in bytes
            begins = np.flatnonzero((blob & 0xC0) != 0x80)
            places_in = np.r_[begins, len(blob)][places_in]
        before = np.searchsorted(edges[1::2], places_in[:, 0], side="right")
        after = np.searchsorted(edges[::2], places_in[:, 1])
        base, total = int(first[nth]), len(edges) // 2
        for i, b, a in zip(some, before.tolist(), after.tolist(), strict=True):
            if b > 1:
                result[i].append(int(pairs[base + b - 2]))
            if b:
                result[i].append(int(left[base + b - 1]))
            if a < total:
                result[i].append(int(right[base + a]))
    return result


SCANNED = (
    "row long, doc_id long, spans array<struct<start:int,kind:int,end:int>>, "
    "tokens array<struct<start:int,kind:int,end:int,token:long,contexts:array<long>>>"
)


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Base spans of each text; its seeds and candidates, of kind below 0, with their contexts."""
    span_type = pa.list_(pa.struct([(n, pa.int32()) for n in ("start", "kind", "end")]))
    token_type = pa.list_(
        pa.struct(
            [(n, pa.int32()) for n in ("start", "kind", "end")]
            + [("token", pa.int64()), ("contexts", pa.list_(pa.int64()))]
        )
    )
    row = TaskContext.get().partitionId() << 33
    for batch in batches:
        texts = batch.column(1).to_pylist()
        all_spans = [base_spans(text) for text in texts]
        found = [
            (t, start, kind, end)
            for t, (text, spans) in enumerate(zip(texts, all_spans, strict=True))
            for start, kind, end in [*spans, *(candidate_tokens(text, spans) if text else ())]
        ]
        before = contexts(texts, [(t, start, end) for t, start, _, end in found])
        values = [texts[t][start:end].encode() for t, start, _, end in found]
        tokens: list[list[dict]] = [[] for _ in texts]
        for (t, start, kind, end), value, some in zip(found, values, before, strict=True):
            if some:
                place = {"start": start, "kind": kind, "end": end}
                tokens[t].append({**place, "token": token_hash(value), "contexts": some})
        spans = [[{"start": a, "kind": k, "end": b} for a, k, b in some] for some in all_spans]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(row, row + len(texts)), pa.int64()),
                batch.column(0),
                pa.array(spans, span_type),
                pa.array(tokens, token_type),
            ],
            names=["row", "doc_id", "spans", "tokens"],
        )
        row += len(texts)


def token_hash(value: bytes) -> int:
    digest = hashlib.blake2b(value, digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def in_blocks(patterns: DataFrame) -> Iterator[DataFrame]:
    """The patterns by a hash of their context, about ``BLOCK`` at a time."""
    blocks = -(-patterns.count() // BLOCK)
    for block in range(blocks):
        yield patterns.where(F.pmod(F.xxhash64("context"), F.lit(blocks)) == block)


def context_counts(docs: DataFrame, text: str, patterns: DataFrame) -> DataFrame:
    """How often the words of each pattern (column context) occur in all documents."""
    spark = docs.sparkSession
    texts = docs.select(whole(text).alias("text"))
    counts = None
    for some in in_blocks(patterns):
        wanted = np.array(sorted(r["context"] for r in some.toLocalIterator()), dtype=np.int64)
        shared = spark.sparkContext.broadcast(wanted)

        def count(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known = shared.value
            total = np.zeros(len(known), dtype=np.int64)
            for batch in batches:
                pairs = all_contexts(batch.column(0).cast(pa.binary()).to_pylist())
                at = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
                if len(known):
                    total += np.bincount(at[known[at] == pairs], minlength=len(known))
            there = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(known[there]), pa.array(total[there])], names=["context", "places"]
            )

        one = texts.mapInArrow(in_small_batches(count), "context long, places long")
        one = one.groupBy("context").agg(F.sum("places").alias("places"))
        counts = one if counts is None else counts.unionByName(one)
    return counts


def trusted_patterns(docs: DataFrame, text: str, tokens: DataFrame) -> DataFrame | None:
    """Patterns (context, kind, confidence) that count, from the graph of contexts and tokens."""
    graph = stored(
        tokens.groupBy("context", "token", "kind").agg(F.count("*").alias("places")), "graph"
    )
    edges = graph.select("context", "token").distinct()
    seeds = graph.where("kind >= 0").select("token", "kind").distinct()
    candidates = graph.where("kind < 0").select(
        "context",
        "token",
        F.explode(
            F.filter(
                F.array(*(F.lit(k) for k in range(len(KINDS)))), lambda k: fits(F.col("kind"), k)
            )
        ).alias("kind"),
    )
    per_context = graph.groupBy("context").agg(
        F.countDistinct("token").alias("tokens"), F.sum("places").alias("places_known")
    )

    def supported(known: DataFrame) -> DataFrame:
        """Patterns whose tokens are known (token, kind, score) often enough."""
        return (
            edges.join(known, "token")
            .groupBy("context", "kind")
            .agg(F.sum("score").alias("score"), F.count("*").alias("support"))
            .join(per_context, "context")
            .withColumn("confidence", F.col("score") / F.col("tokens"))
            .where((F.col("support") >= LEAST_KNOWN) & (F.col("confidence") >= LEAST_CONFIDENCE))
        )

    # Were all candidates known, these could count; their words are looked for once, in all texts.
    at_best = seeds.unionByName(candidates.select("token", "kind")).distinct()
    possible = stored(supported(at_best.withColumn("score", F.lit(1.0))), "possible")
    if possible.isEmpty():
        return None
    counts = context_counts(docs, text, possible.select("context").distinct())
    able = stored(
        possible.join(counts, "context")
        .where(F.col("places_known") >= LEAST_SHARE * F.col("places"))
        .select("context", "kind"),
        "able",
    )
    known, trusted = seeds.withColumn("score", F.lit(1.0)), None
    while True:
        new = supported(known).join(able, ["context", "kind"], "left_semi")
        if trusted is not None:
            new = new.join(trusted, ["context", "kind"], "left_anti")
        new = stored(new.select("context", "kind", "confidence"), "patterns")
        if new.isEmpty():
            return trusted
        trusted = new if trusted is None else trusted.unionByName(new)
        learnt = (
            candidates.join(trusted, ["context", "kind"])
            .groupBy("token", "kind")
            .agg(F.max("confidence").alias("score"))
        )
        known = seeds.withColumn("score", F.lit(1.0)).unionByName(learnt)


def fits(shape: Column, kind: Column) -> Column:
    """If an unknown identifier of the shape may be of the kind."""
    found = F.lit(False)
    for one, kinds in FITS.items():
        found = found | ((shape == one) & kind.isin(*kinds))
    return found


def told(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    one = F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"]))
    return F.array_join(one, ",")


def identifiers(docs: DataFrame, id_col: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The scanned rows, and one row for each identifier and candidate with a context."""
    prepare(docs.sparkSession)
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(text).alias("text"))
    scanned = stored(picked.mapInArrow(in_small_batches(scan), SCANNED), "identifiers")
    tokens = scanned.where(F.size("tokens") > 0).select("row", F.explode("tokens").alias("t"))
    named = tokens.select("row", "t.*").withColumn("context", F.explode("contexts"))
    return scanned, named.drop("contexts")


def found_spans(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, base and spans of every row of docs: arrays of (start, kind, end), in order.

    ``spans`` has the base ones and those of the contextual patterns.
    """
    scanned, tokens = identifiers(docs, id_col, text)
    trusted = trusted_patterns(docs, text, tokens)
    if trusted is None:
        return scanned.select("doc_id", F.col("spans").alias("base"), "spans")
    extra = (
        tokens.where("kind < 0")
        .withColumnRenamed("kind", "shape")
        .join(trusted.select("context", "kind", "confidence"), "context")
        .where(fits(F.col("shape"), F.col("kind")))
        .groupBy("row", "start", "end")
        .agg(F.max_by("kind", F.struct("confidence", "kind")).alias("found_kind"))
        .groupBy("row")
        .agg(
            F.collect_list(F.struct("start", F.col("found_kind").alias("kind"), "end")).alias(
                "extra"
            )
        )
    )
    both = F.when(F.col("extra").isNull(), F.col("spans")).otherwise(
        F.sort_array(F.concat("spans", "extra"))
    )
    return scanned.join(extra, "row", "left").select(
        "doc_id", F.col("spans").alias("base"), both.alias("spans")
    )


def masked_text(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with a mark of the kind in place of each span; spans that overlap become one."""
    parts, reached = [], 0
    for start, kind, end in sorted(spans):
        if start >= reached:
            parts += [text[reached:start], f"<{KINDS[kind].upper()}>"]
        reached = max(reached, end)
    return "".join([*parts, text[reached:]])


def masked(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows and columns of docs with the personal data in ``text`` replaced by marks.

    A column n_chars follows the new text. Patterns are learnt in a first scan and broadcast for
    the second; beyond ``BLOCK`` patterns, further scans add what those of the next block find in
    the same text, which is masked once, by the last.
    """
    _, tokens = identifiers(docs, id_col, text)
    trusted = trusted_patterns(docs, text, tokens)
    blocks = [None] if trusted is None else list(in_blocks(stored(trusted, "kinds"))) or [None]
    place = docs.columns.index(text)
    counted = docs.columns.index("n_chars") if "n_chars" in docs.columns else None
    best_type = pa.list_(
        pa.struct([(n, pa.int32()) for n in ("start", "end", "kind")] + [("score", pa.float64())])
    )
    rows = docs.select(
        F.struct("*").alias("row"),
        F.array().cast("array<struct<start:int,end:int,kind:int,score:double>>").alias("best"),
    )
    for nth, block in enumerate(blocks):
        known_kinds: dict[int, list[tuple[float, int]]] = {}
        for found in () if block is None else block.toLocalIterator():
            known_kinds.setdefault(found["context"], []).append((found["confidence"], found["kind"]))
        shared = docs.sparkSession.sparkContext.broadcast(known_kinds)
        last = nth == len(blocks) - 1

        def mask(
            batches: Iterator[pa.RecordBatch], shared=shared, last=last
        ) -> Iterator[pa.RecordBatch]:
            known = shared.value
            for batch in batches:
                struct = batch.column(0)
                fields = [struct.field(i) for i in range(struct.type.num_fields)]
                texts, so_far = fields[place].to_pylist(), batch.column(1).to_pylist()
                changed = [False] * len(texts)
                for i, value in enumerate(texts):
                    if not value:
                        continue
                    spans = base_spans(value)
                    best = {(b["start"], b["end"]): (b["score"], b["kind"]) for b in so_far[i]}
                    if known:
                        found = candidate_tokens(value, spans)
                        places = [(0, start, end) for start, _, end in found]
                        for (start, shape, end), some in zip(
                            found, contexts([value], places), strict=True
                        ):
                            fit = [k for c in some for k in known.get(c, ()) if k[1] in FITS[shape]]
                            if fit:
                                old = best.get((start, end), fit[0])
                                best[start, end] = max(old, *fit)
                    if not last:
                        so_far[i] = [
                            {"start": a, "end": e, "kind": kind, "score": score}
                            for (a, e), (score, kind) in best.items()
                        ]
                        continue
                    spans = spans + [(start, kind, end) for (start, end), (_, kind) in best.items()]
                    if spans:
                        texts[i], changed[i] = masked_text(value, spans), True
                if not last:
                    yield pa.RecordBatch.from_arrays(
                        [struct, pa.array(so_far, best_type)], names=["row", "best"]
                    )
                    continue
                fields[place] = pa.array(texts, fields[place].type)
                if counted is not None:
                    old, kind = fields[counted].to_pylist(), fields[counted].type
                    new = (len(t) if c else n for t, c, n in zip(texts, changed, old, strict=True))
                    fields[counted] = pa.array(new, kind)
                whole_rows = pa.StructArray.from_arrays(fields, fields=list(struct.type))
                yield pa.RecordBatch.from_arrays([whole_rows], names=["row"])

        schema = rows.select("row").schema if last else rows.schema
        rows = rows.mapInArrow(in_small_batches(mask), schema)
    return rows.select("row.*")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans of every row.

    The counts and the digest are of the fixed patterns; ``spans`` also has the others.
    """
    found = found_spans(docs, id_col, text)

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)),
        F.sha2(told(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        told(F.col("spans")).alias("spans"),
    )
