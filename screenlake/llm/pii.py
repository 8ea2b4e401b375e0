"""Personal data: patterns, and terms that give protected entities away.

The first pass finds e-mail addresses, IP addresses, card and phone numbers, and the terms of the texts that hold
them. How much a term discloses of an entity is estimated from the documents of the corpus in which both occur: with
k documents of both, n of the term and the entity in a share p of all documents,

    q = (k + prior * p) / (n + prior)

is the chance of the entity once the term is known, drawn towards p where there is little evidence, so rare entities
are judged by the same rule as others. -log2 q bits of the entity are then still hidden. A term that leaves at most
``generalise_bits`` hidden is generalised to a class, at most ``remove_bits`` removed, wherever it occurs. A term must
reveal at least ``least_gain`` bits (log2 q / p), must not be a function word, and needs evidence from two texts in
which the entity's surroundings differ: copies of one text are one witness.

Counts are combined before they are shuffled. Pairs that cannot reach a threshold whatever n is are left out before
terms are counted; that changes no result. Lists of terms are written, so Spark broadcasts them when they are below
its threshold and shuffles otherwise.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenlake.llm.common import bloom_filter, text_slices, written
from screenlake.llm.quality import COMMON

KINDS = ("email", "ip", "card", "phone")
#: An address is found from its @ to both sides: an e-mail rule that starts at every letter takes quadratic time.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: Runs of letters and digits, and of anything beyond ASCII; the same rule cuts texts in Spark.
TERM = re.compile(r"[A-Za-z0-9\x80-\U0010FFFF]+")
BETWEEN = r"[\x00-/:-@\[-`{-\x7F]+"

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def emails(text: str) -> Iterator[Span]:
    end = 0
    for found in DOMAIN.finditer(text):
        start = found.start()
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < found.start():
            end = found.end()
            yield "email", start, end


def base_spans(text: str) -> list[Span]:
    """Spans by kind, then start; matches that fail their check are dropped."""
    spans = list(emails(text)) if "@" in text else []
    if "." in text:
        for m in IP.finditer(text):
            if all(len(p) <= 3 and int(p) <= 255 for p in (part.lstrip("0") or "0" for part in m[0].split("."))):
                spans.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                spans.append(("phone", m.start(), m.end()))
    return spans


def entity(text: str, span: Span) -> str:
    """What a span stands for, however it is written."""
    found = text[span[1] : span[2]]
    return f"{span[0]}:{found.lower() if span[0] in ('email', 'ip') else re.sub('[^0-9]', '', found)}"


def free_terms(text: str, spans: list[Span]) -> list[tuple[int, int]]:
    """Terms that do not touch a span."""
    taken = sorted((s, e) for _, s, e in spans)
    out, at = [], 0
    reach = 0
    for m in TERM.finditer(text):
        while at < len(taken) and taken[at][0] < m.end():
            reach = max(reach, taken[at][1])
            at += 1
        if m.start() >= reach:
            out.append((m.start(), m.end()))
    return out


def entity_documents(frame: DataFrame, context: int) -> DataFrame:
    """(entities, terms) of every text that holds an entity: each entity (name, around) and each other term once.

    ``around`` is a hash of the ``context`` terms on both sides of the entity's first mention.
    """
    named = pa.struct([("name", pa.string()), ("around", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in text_slices(batch, "text"):
                entities, terms = [], []
                for text in texts:
                    spans = base_spans(text)
                    if not spans:
                        continue
                    places = free_terms(text, spans)
                    starts = [s for s, _ in places]
                    seen: dict[str, int] = {}
                    for span in spans:
                        name = entity(text, span)
                        if name not in seen:
                            at = bisect_left(starts, span[1])
                            near = " ".join(text[s:e].lower() for s, e in places[max(0, at - context) : at + context])
                            seen[name] = int.from_bytes(hashlib.blake2b(near.encode(), digest_size=8).digest(), "little", signed=True)
                    entities.append([{"name": name, "around": around} for name, around in seen.items()])
                    terms.append(list({text[s:e].lower() for s, e in places}))
                yield pa.RecordBatch.from_arrays([pa.array(entities, pa.list_(named)), pa.array(terms, pa.list_(pa.string()))], ["entities", "terms"])

    return frame.select("text").mapInArrow(run, "entities array<struct<name: string, around: bigint>>, terms array<string>")


def document_terms(frame: DataFrame, *keep: str) -> DataFrame:
    """One row per distinct term of each text, lower-cased."""
    terms = F.array_distinct(F.array_remove(F.split(F.lower("text"), BETWEEN), ""))
    return frame.select(*keep, F.explode(terms).alias("term"))


def only(terms: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows whose ``term`` may be in ``wanted``, found where they are."""
    asked = bloom_filter(wanted.select("term"), ["term"])
    return terms if asked is None else terms.where(asked(F.col("term")))


def disclosures(frame: DataFrame, prior: float, most_bits: float, least_gain: float, context: int) -> DataFrame:
    """(entity, term, together, with_entity, with_term, hidden_bits, gained_bits) of all pairs within both thresholds."""
    total = max(frame.count(), 1)
    documents = written(entity_documents(frame, context), "entity_documents")
    chance = lambda k, n: (k + prior * F.col("with_entity") / total) / (n + prior)
    hidden = lambda k, n: -F.log2(chance(k, n))
    mentions = documents.select(F.explode("entities").alias("e"), "terms").select("e.*", "terms")
    witnessed = F.col("a") != F.col("b")
    entities = mentions.groupBy("name").agg(F.count(F.lit(1)).alias("with_entity"), F.min("around").alias("a"), F.max("around").alias("b"))
    # no term leaves less hidden than one that stands in all of the entity's documents and nowhere else
    reachable = written(entities.where(witnessed & (hidden(F.col("with_entity"), F.col("with_entity")) <= most_bits)).select("name", "with_entity"), "entities")
    each = mentions.join(reachable, "name").select("name", "with_entity", "around", F.explode("terms").alias("term"))
    pairs = each.groupBy("name", "with_entity", "term").agg(F.count(F.lit(1)).alias("together"), F.min("around").alias("a"), F.max("around").alias("b"))
    function_words = sorted({word for words in COMMON.values() for word in words})
    pairs = written(pairs.where(witnessed & (hidden(F.col("together"), F.col("together")) <= most_bits) & ~F.col("term").isin(function_words)).drop("a", "b"), "pairs")
    wanted = written(pairs.select("term").distinct(), "terms")
    # the filter leaves hardly any other term; those that pass by chance fall out of the small join behind the counts
    counts = only(document_terms(frame), wanted).groupBy("term").agg(F.count(F.lit(1)).alias("with_term"))
    counts = written(counts.join(wanted, "term", "left_semi"), "counts")
    scored = pairs.join(counts, "term").withColumn("hidden_bits", hidden(F.col("together"), F.col("with_term")))
    scored = scored.withColumn("gained_bits", F.log2(F.lit(float(total)) / F.col("with_entity")) - F.col("hidden_bits"))
    scored = scored.where((F.col("hidden_bits") <= most_bits) & (F.col("gained_bits") >= least_gain))
    return scored.select(F.col("name").alias("entity"), "term", "together", "with_entity", "with_term", "hidden_bits", "gained_bits")


def disclosing_terms(frame: DataFrame, prior: float, generalise_bits: float, remove_bits: float, least_gain: float, context: int) -> DataFrame:
    """(term, action) of the terms whose disclosure of some entity reaches a threshold, written."""
    scored = disclosures(frame, prior, max(generalise_bits, remove_bits), least_gain, context).groupBy("term").agg(F.min("hidden_bits").alias("hidden"))
    return written(scored.select("term", F.when(F.col("hidden") <= remove_bits, "remove").otherwise("generalise").alias("action")), "disclosing")


def generalised(term: str) -> str:
    if any(c.isdigit() for c in term):
        return "[NUMBER]"
    return "[NAME]" if term[:1].isupper() else "[TERM]"


def sanitise(
    docs: DataFrame, prior: float = 2.0, generalise_bits: float = 1.2, remove_bits: float = 0.5, least_gain: float = 2.0, context: int = 8,
    key: str = "doc_id", text: str = "text", carry: tuple[str, ...] = (),
) -> DataFrame:
    """(key, text, n_email, n_ip, n_card, n_phone, base, spans[, carried columns]) of every row.

    ``text`` has base spans replaced by their kind and disclosing terms generalised or taken out. ``base`` and
    ``spans`` list kind:start:end in code points, by kind (email, ip, card, phone, then generalise, remove), then
    start, joined by commas; terms that touch a base span are left to it. With the defaults a term is generalised from
    two independent documents on that it shares with an entity alone, and removed from five on. ``context`` is the
    number of terms that tell surroundings apart, no limit to where terms are counted. A null text counts as empty and has no
    spans. Repeated rows count as documents each. Null keys stay null. An empty table gives no rows.
    """
    frame = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), *[F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)])
    disclosing = disclosing_terms(frame.select("key", "text"), prior, generalise_bits, remove_bits, least_gain, context)
    hits = only(document_terms(frame, "key"), disclosing).join(disclosing, "term").groupBy("key").agg(F.map_from_entries(F.collect_set(F.struct("term", "action"))).alias("terms"))
    hits = written(hits, "hits").withColumnRenamed("key", "hit_key")
    joined = frame.join(hits, frame["key"].eqNullSafe(F.col("hit_key")), "left").drop("hit_key")
    others = [f for f in frame.schema if f.name.startswith("carry_")]
    kind = frame.schema["key"].dataType.simpleString()
    columns = f"key {kind}, text string, {', '.join(f'n_{k} long' for k in KINDS)}, base string, spans string"
    schema = ", ".join([columns, *(f"{f.name} {f.dataType.simpleString()}" for f in others)])
    order = {kind: i for i, kind in enumerate((*KINDS, "generalise", "remove"))}
    shown = lambda spans: ",".join(f"{k}:{s}:{e}" for k, s, e in spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {name: batch.schema.get_field_index(name) for name in batch.schema.names}
            for start, texts in text_slices(batch, "text"):
                part = batch.slice(start, len(texts))
                cleaned, base, spans = [], [], []
                counts = {k: [] for k in KINDS}
                for text, terms in zip(texts, part.column(at["terms"])):
                    found = base_spans(text)
                    extra: list[Span] = []
                    if terms.is_valid and len(terms):
                        actions = dict(terms.as_py())
                        extra = [(actions[t], s, e) for s, e in free_terms(text, found) if (t := text[s:e].lower()) in actions]
                        extra.sort(key=lambda span: (order[span[0]], span[1]))
                    for k in KINDS:
                        counts[k].append(sum(span[0] == k for span in found))
                    base.append(shown(found))
                    spans.append(shown(found + extra))
                    cleaned.append(replaced(text, found + extra))
                arrays = [part.column(at["key"]), pa.array(cleaned, pa.string()), *(pa.array(counts[k], pa.int64()) for k in KINDS), pa.array(base, pa.string()), pa.array(spans, pa.string())]
                arrays += [part.column(at[f.name]) for f in others]
                yield pa.RecordBatch.from_arrays(arrays, ["key", "text", *(f"n_{k}" for k in KINDS), "base", "spans", *(f.name for f in others)])

    result = joined.mapInArrow(run, schema)
    return result.withColumnsRenamed({"key": key, "text": text, **{f"carry_{i}": c for i, c in enumerate(carry)}})


def replaced(text: str, spans: list[Span]) -> str:
    """Text with each span replaced; of spans that overlap, the first and then the longest decides."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda span: (span[1], -span[2])):
        if start < at:
            at = max(at, end)
            continue
        out.append(text[at:start])
        if kind != "remove":
            out.append(generalised(text[start:end]) if kind == "generalise" else f"[{kind.upper()}]")
        at = end
    out.append(text[at:])
    return "".join(out)
