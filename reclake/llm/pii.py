"""Information-theoretic sanitisation: personal data by pattern, and terms that reveal it by co-occurrence."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from reclake.llm.common import BLANKS, WORD, word_array
from reclake.llm.registry import query, table
from reclake.session import materialize

# ---- fixed values: kinds in their order, patterns ----
KINDS = ["email", "ip", "card", "phone", "term"]
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
OUTER = ".,;:!?()[]{}<>\"'"
# ---- end of fixed values ----
CONTEXT_WORDS = 10
CONTEXT_CHARS = 400
MIN_CONTEXTS = 3
GENERALISE_AT, REMOVE_AT = 0.8, 0.95
MAX_BROADCAST_TERMS = 500_000
STEP = 512

Span = tuple[int, int, int]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the address pattern, found from each ``@``; linear where a search from every letter would not be."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield start, end
        else:
            end = max(end, at + 1)
        at = text.find("@", max(end, at + 1))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """``(start, kind, end)`` of the pattern matches in code points, sorted; ``kind`` indexes ``KINDS``."""
    spans = [(start, 0, end) for start, end in _emails(text)]
    spans += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(map(_small, m.groups()))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                spans.append((m.start(), 2, m.end()))
    if "+" in text:
        spans += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= sum(map(str.isdigit, m.group())) <= 15]
    return sorted(spans)


def _entity(text: str, span: Span) -> str:
    """A protected entity is a value, however it is written: addresses in lower case, numbers without separators."""
    start, kind, end = span
    found = text[start:end]
    value = found.lower() if kind == 0 else found if kind == 1 else re.sub("[^0-9]", "", found)
    return f"{KINDS[kind]}:{value}"


def _context(text: str, span: Span, taken: list[Span]) -> list[tuple[str, int, int]]:
    """Up to ``CONTEXT_WORDS`` words on each side within ``CONTEXT_CHARS``, without personal data: term, start, end."""
    start, _, end = span
    low, high = max(0, start - CONTEXT_CHARS), min(len(text), end + CONTEXT_CHARS)
    before = [(m.start(), m.end()) for m in WORD.finditer(text, low, start)]
    after = [(m.start(), m.end()) for m in WORD.finditer(text, end, high)]
    if before and before[0][0] == low and low and text[low - 1] not in BLANKS:
        before.pop(0)
    if after and after[-1][1] == high and high < len(text) and text[high] not in BLANKS:
        after.pop()
    near = []
    for word_start, word_end in before[-CONTEXT_WORDS:] + after[:CONTEXT_WORDS]:
        word = text[word_start:word_end]
        word_start += len(word) - len(word.lstrip(OUTER))
        term = word.strip(OUTER)
        word_end = word_start + len(term)
        whole = word_start >= end or word_end <= start
        if term and whole and not any(s < word_end and word_start < e for s, _, e in taken):
            near.append((term.lower(), word_start, word_end))
    return near


def _terms_between(text: str, spans: list[Span]) -> Iterator[tuple[str, int, int]]:
    """All words of what base spans leave of a text: term, start, end. ``spans`` are sorted."""
    at = 0
    for start, _, end in [*spans, (len(text), 0, len(text))]:
        for m in WORD.finditer(text, at, start) if at < start else ():
            word = m.group()
            term = word.strip(OUTER)
            if term:
                begin = m.start() + len(word) - len(word.lstrip(OUTER))
                yield term.lower(), begin, begin + len(term)
        at = max(at, end)


def _run(docs: DataFrame, work, schema: str) -> DataFrame:
    """``work(text)`` gives the row, a dictionary, of every document; columns by ``schema`` after ``doc_id``."""
    narrow = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    returned = f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, {schema}"
    fields = [(field.name, to_arrow_type(field.dataType)) for field in docs.sparkSession.createDataFrame([], schema).schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                rows = [work(text) for text in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array([row[name] for row in rows], kind) for name, kind in fields]],
                    ["doc_id", *[name for name, _ in fields]])

    return narrow.mapInArrow(run, returned)


SPANS = "spans array<struct<start:int,kind:int,end:int,disclosure:double>>"
NEAR = "near array<struct<entity:string,term:string,context:bigint>>"


def detect(docs: DataFrame) -> DataFrame:
    """Per row ``doc_id`` and ``near``: the terms around each protected entity of the text."""
    return _run(docs, lambda text: {"near": _near(text, base_spans(text))}, NEAR)


def _near(text: str, spans: list[Span]) -> list[dict]:
    """One entry per entity and term of a text; ``context`` is a hash of the words around the entity's first mention."""
    found: dict[tuple[str, str], int] = {}
    for span in spans:
        entity, words = _entity(text, span), _context(text, span, spans)
        digest = xxhash.xxh64_intdigest(" ".join(word for word, _, _ in words)) - (1 << 63)
        for term, _, _ in words:
            found.setdefault((entity, term), digest)
    return [{"entity": e, "term": t, "context": digest} for (e, t), digest in found.items()]


def revealing_terms(
    docs: DataFrame, findings: DataFrame, min_contexts: int = MIN_CONTEXTS, threshold: float = GENERALISE_AT,
    max_broadcast: int = MAX_BROADCAST_TERMS,
) -> DataFrame:
    """``entity``, ``term``, ``disclosure`` of the terms that reveal an entity.

    The information content of entity e is -log p(e), the pointwise mutual information of e and term t is
    log p(e|t) / p(e); probabilities are shares of documents. ``disclosure`` is their ratio: 1 if t occurs only near e.
    A pair needs ``min_contexts`` different contexts, so copies of one passage are one piece of evidence. Pairs and terms
    are counted before they are shuffled; a pair in very many documents is first counted per context. Documents per
    candidate term are counted over the whole corpus: candidates up to ``max_broadcast`` are broadcast, above that
    all terms are counted and joined.
    """
    near = findings.select(F.explode("near").alias("_x")).select("_x.entity", "_x.term", "_x.context")
    per_context = near.groupBy("entity", "term", "context").agg(F.count("*").alias("_n"))
    pairs = per_context.groupBy("entity", "term").agg(F.sum("_n").alias("both"), F.count("*").alias("_contexts"))
    pairs = materialize(pairs.filter(F.col("_contexts") >= min_contexts), "entity-terms")
    entities = findings.select(F.explode(F.array_distinct(F.col("near.entity"))).alias("entity"))
    entities = entities.groupBy("entity").agg(F.count("*").alias("docs_e"))
    wanted = pairs.select(F.xxhash64("term").alias("_t")).distinct()
    term = F.btrim(F.lower(F.col("_w")), F.lit(OUTER))
    words = docs.select(F.explode(F.array_distinct(word_array(F.coalesce("text", F.lit(""))))).alias("_w"))
    words = words.select(F.xxhash64(term).alias("_t"))
    if wanted.count() <= max_broadcast:
        words = words.join(F.broadcast(wanted), "_t", "left_semi")
    # Two spellings of a term in one text count twice here, which lowers its disclosure.
    terms = words.groupBy("_t").agg(F.count("*").alias("docs_t"))
    total = docs.count()
    scored = (
        pairs.withColumn("_t", F.xxhash64("term")).join(terms, "_t").join(entities, "entity")
        .withColumn("_share", F.least(F.lit(1.0), F.col("both") / F.col("docs_t")))
        .withColumn("_content", F.log(F.lit(float(total)) / F.col("docs_e")))
    )
    scored = scored.withColumn("disclosure", F.when(F.col("_content") > 0, 1 + F.log("_share") / F.col("_content")))
    return scored.filter(F.col("disclosure") >= threshold).select("entity", "term", "disclosure")


def _span(start: int, kind: int, end: int, disclosure: float | None = None) -> dict:
    return {"start": start, "kind": kind, "end": end, "disclosure": disclosure}


def mark(docs: DataFrame, terms: DataFrame, max_broadcast: int = MAX_BROADCAST_TERMS, clean: bool = False) -> DataFrame:
    """Per row ``doc_id`` and ``spans``: base spans and every place of the ``terms`` (``term``, ``disclosure``), each once.

    With ``clean`` also ``text``, sanitised in the same pass over the row, so that every row gets the spans of its own text. Up to ``max_broadcast`` terms are sent to the tasks, which look up all words of all documents. More are joined with the
    words by a shuffle; what is found comes back by two hashes of the text, so that no text is shuffled.
    """
    term_kind = KINDS.index("term")
    if terms.count() <= max_broadcast:
        shipped = docs.sparkSession.sparkContext.broadcast({row["term"]: row["disclosure"] for row in terms.collect()})

        def all_spans(text: str) -> dict:
            base, known = base_spans(text), shipped.value
            spans = [_span(*span) for span in base]
            if known:
                spans += [_span(s, term_kind, e, known[t]) for t, s, e in _terms_between(text, base) if t in known]
                spans.sort(key=lambda span: (span["start"], span["kind"], span["end"]))
            return {"spans": spans, "text": sanitise_text(text, spans)} if clean else {"spans": spans}

        return _run(docs, all_spans, f"text string, {SPANS}" if clean else SPANS)

    def digests(text: str) -> dict:
        data = text.encode("utf-8", "surrogatepass")
        return {"_one": xxhash.xxh64_intdigest(data) - (1 << 63), "_two": xxhash.xxh64_intdigest(data, 7) - (1 << 63)}

    def base_only(text: str) -> dict:
        found = {**digests(text), "_base": [_span(*span) for span in base_spans(text)]}
        return {**found, "_text": text} if clean else found

    def words(text: str) -> dict:
        places: dict[str, list[dict]] = {}
        for term, start, end in _terms_between(text, base_spans(text)):
            places.setdefault(term, []).append({"start": start, "end": end})
        return {**digests(text), "words": [{"term": term, "places": at} for term, at in places.items()]}

    listed = _run(docs, words, "_one long, _two long, words array<struct<term:string,places:array<struct<start:int,end:int>>>>")
    listed = listed.select("_one", "_two", F.explode("words").alias("_x")).select("_one", "_two", "_x.term", "_x.places")
    marked = listed.join(terms, "term").select("_one", "_two", "disclosure", F.explode("places").alias("_p"))
    added = marked.groupBy("_one", "_two").agg(F.collect_set(F.struct(
        F.col("_p.start").alias("start"), F.lit(term_kind).alias("kind"), F.col("_p.end").alias("end"), "disclosure",
    )).alias("_added"))
    based = _run(docs, base_only, "_one long, _two long, " + SPANS.replace("spans", "_base", 1) + (", _text string" if clean else ""))
    both = F.when(F.col("_added").isNull(), F.col("_base")).otherwise(F.array_sort(F.concat("_base", "_added")))
    joined = based.join(added, ["_one", "_two"], "left")
    if not clean:
        return joined.select("doc_id", both.alias("spans"))
    joined = joined.select("doc_id", F.col("_text").alias("text"), both.alias("spans"))

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [sanitise_text(*row) for row in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), batch.column(2)], ["doc_id", "text", "spans"])

    return joined.mapInArrow(replace, joined.schema)


def _all_revealing(docs: DataFrame, min_contexts: int, threshold: float, max_broadcast: int) -> DataFrame:
    findings = materialize(detect(docs), "private")
    shown = revealing_terms(docs, findings, min_contexts, threshold, max_broadcast)
    return materialize(shown.groupBy("term").agg(F.max("disclosure").alias("disclosure")), "revealing")


def find_private(
    docs: DataFrame, min_contexts: int = MIN_CONTEXTS, threshold: float = GENERALISE_AT,
    max_broadcast: int = MAX_BROADCAST_TERMS,
) -> DataFrame:
    """Per row ``doc_id`` and ``spans``: the base spans and the terms that reveal an entity, by start and kind.

    A span has ``start``, ``kind`` (an index into ``KINDS``), ``end`` (exclusive) and ``disclosure`` (null for base spans).
    Contexts of entities only tell which terms reveal one; such a term is marked at all its places in all documents, with its
    highest disclosure. Null or empty text: no spans. A missing id is kept as it is. Repeated rows count as documents of
    their own and get the same spans. Other columns are dropped.
    """
    return mark(docs, _all_revealing(docs, min_contexts, threshold, max_broadcast), max_broadcast)


def _shape(word: str) -> str:
    """What a term is generalised to."""
    return "[NUMBER]" if any(map(str.isdigit, word)) else "[NAME]" if word[:1].isupper() else "[WORD]"


def sanitise_text(text: str, spans: list[dict], remove_at: float = REMOVE_AT) -> str:
    """``text`` with base spans replaced by their kind, strongly revealing terms removed and others generalised."""
    out, at = [], 0
    for span in sorted(spans, key=lambda s: (s["start"], s["kind"])):
        if span["start"] < at:  # inside an earlier one: only what sticks out goes
            at = max(at, span["end"])
            continue
        out.append(text[at:span["start"]])
        if span["disclosure"] is None:
            out.append(f"[{KINDS[span['kind']].upper()}]")
        elif span["disclosure"] < remove_at:
            out.append(_shape(text[span["start"]:span["end"]]))
        at = span["end"]
    return "".join([*out, text[at:]])


def sanitise(
    docs: DataFrame, min_contexts: int = MIN_CONTEXTS, threshold: float = GENERALISE_AT,
    max_broadcast: int = MAX_BROADCAST_TERMS,
) -> DataFrame:
    """``doc_id``, ``text`` with what :func:`find_private` finds taken out, and ``spans`` in the text as it was.

    A row is cleaned by the spans of its own text, in the pass that finds them; so ids may be missing or stand for several texts.
    """
    return mark(docs, _all_revealing(docs, min_contexts, threshold, max_broadcast), max_broadcast, clean=True)


def _listed(spans):
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


@query("op1_pii")
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_private(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < KINDS.index("term"))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{name}") for kind, name in enumerate(KINDS)
    ]
    return found.select("doc_id", *counts[:4], F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"), counts[4])
