"""Personal data, and the terms that give it away.

Values found by pattern (mail addresses, network addresses, card and phone numbers) are the protected entities. A term
discloses an entity as far as the corpus says so: with p(c) the share of rows that hold entity c and p(c|t) the share
of the rows with term t that hold c, wherever in the text, the disclosure is PMI(c; t) / IC(c) = 1 - log p(c|t) / log p(c),
which is 1 if the term occurs nowhere else. In a document that holds c, every occurrence of a term above one threshold is
generalised to its class, above a higher one removed. A term must have been seen with c in several different texts;
equal texts are one observation.

Counts cover all rows and whole texts. An entity in fewer texts than that has no such term, nor has a term in fewer texts
that hold an entity any entity, so both are left out before pairs are made; pairs are counted within a task first. Terms
to count are passed to the scan as a bitmap of fixed size over their hashes: it grows with nothing, and a term that it
lets through by chance is dropped by the join or the exact support that follows. A document meets only those
disclosing terms that it holds itself, so an entity in a third of all rows is an ordinary key.

Defined results: a null text is empty and has no span; repeated rows give repeated results; a null id is kept; other
columns pass through as they are, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollkeep.llm.common import free_name, id_files, in_files, python_tasks, table_files
from rollkeep.llm.encoders import tidy
from rollkeep.sources.staging import staged

# The base kinds in their order.
KINDS = ("email", "ip", "card", "phone")
ADDED = ("generalised", "removed")
HELD = 1 << 16  # rows of an entity and a term that a task holds before it sends them
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A failed attempt inside a run of digits can't succeed further on in it, so runs are tried once.
ADDRESS = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")
TERM = re.compile(r"[^\W_]+")

SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


@dataclass(frozen=True)
class Disclosure:
    """``texts``: different texts in which a term must stand with an entity. ``generalise_at``, ``remove_at``: thresholds
    on the disclosure. ``filter_bits``: of the hash that the bitmaps are indexed by; 24 are 2 MB."""

    texts: int = 3
    generalise_at: float = 0.85
    remove_at: float = 0.95
    filter_bits: int = 24


def _luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(c), 10)) for c in even)) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    low, at = 0, text.find("@")
    while at >= 0:
        start = low + len(text[low:at].rstrip(LOCAL))
        found = DOMAIN.match(text, at + 1) if start < at else None
        low = found.end() if found else at + 1
        if found:
            yield start, low
        at = text.find("@", low)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base kinds, by start and then kind."""
    spans = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for m in ADDRESS.finditer(text):
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m[0].split("."))):
                spans.append(("ip", *m.span()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = NOT_DIGIT.sub("", m[0])
                if 12 <= len(digits) <= 19 and _luhn(digits):
                    spans.append(("card", *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                    spans.append(("phone", *m.span()))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def entity(kind: str, value: str) -> str:
    """One form for an entity however it is written."""
    return f"{kind}:{value.lower() if kind in ('email', 'ip') else NOT_DIGIT.sub('', value)}"


def terms(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Places of the terms that overlap no span."""
    out, k = [], 0
    ends = sorted((a, b) for _, a, b in spans)
    for m in TERM.finditer(text):
        while k < len(ends) and ends[k][1] <= m.start():
            k += 1
        if not any(a < m.end() and m.start() < b for a, b in ends[k : k + 4]):
            out.append(m.span())
    return out


def _slot(term: str, bits: int) -> int:
    return zlib.crc32(term.encode()) & ((1 << bits) - 1)


def _bitmap(terms_table: DataFrame, bits: int) -> bytes:
    """A bitmap over the hashes of a column ``term``; its size is set by ``bits`` alone."""
    slot = F.crc32(F.col("term").cast("binary")).bitwiseAND(F.lit((1 << bits) - 1))
    parts = terms_table.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("part"))
    rows = parts.agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect()
    out = bytearray((1 << bits) // 8 + 4096)
    for row in rows:  # parts are numbered from 1, with 32768 bits each; slot 0 alone is in part 0 or 1
        at = max(0, row["part"] - 1) * 4096
        out[at : at + 4096] = bytes(a | b for a, b in zip(out[at : at + 4096], row["bits"]))
    return bytes(out)


def _has(bitmap: bytes, slot: int) -> bool:
    # Positions within a part run from 0 for slots 1, 32769, ...; see bitmap_bit_position.
    place = (slot - 1) if slot > 0 else 0
    return bool(bitmap[place >> 3] >> (place & 7) & 1)


def find(docs: DataFrame, text: str, keep_text: bool) -> tuple[DataFrame, dict[str, str]]:
    """The rows with their base spans, a number and their text's hash, staged; without ``keep_text`` only texts with spans."""
    python_tasks(docs.sparkSession, 256)
    name = {k: free_name(docs, k) for k in ("row_number_", "text_hash_", "base_spans_")}
    fields = [*docs.schema.fields, T.StructField(name["row_number_"], T.LongType()), T.StructField(name["text_hash_"], T.LongType()), T.StructField(name["base_spans_"], SPANS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            at = batch.schema.get_field_index(text)
            values = [t or "" for t in batch.column(at).to_pylist()]
            spans = [base_spans(t) for t in values]
            columns = [batch.column(i) for i in range(batch.num_columns)]
            hashes = columns.pop()
            if not keep_text:
                columns[at] = pa.array([t if s else None for t, s in zip(values, spans)], type=pa.string())
            rows = pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in spans], type=pa.list_(SPAN))
            numbers = pa.array(range(number, number + len(values)), type=pa.int64())
            number += len(values)
            yield pa.RecordBatch.from_arrays([*columns, numbers, hashes, rows], names=[f.name for f in fields])

    hashed = in_files(docs, table_files(docs)).withColumn(name["text_hash_"], F.xxhash64(text))
    return staged(hashed.mapInArrow(tidy(run), T.StructType(fields)), "personal"), name


def disclosing(found: DataFrame, docs: DataFrame, text: str, name: dict[str, str], rules: Disclosure) -> DataFrame:
    """(entity, term, action) over the whole corpus; ``found`` as :func:`find` gives it."""
    held = found.where(F.size(name["base_spans_"]) > 0).select(
        F.col(name["row_number_"]).alias("row"), F.col(name["text_hash_"]).alias("hash"), F.col(text).alias("text"), F.col(name["base_spans_"]).alias("spans")
    )

    files, few = table_files(docs), id_files(docs)
    # Equal texts are one observation: one row stands for all of them.
    held = held.withColumn("entities", _entities("text", "spans"))
    alike = held.groupBy("hash").agg(F.min("row").alias("row"), F.count("*").alias("rows"))
    several = held.select("hash", F.explode("entities").alias("term")).groupBy("term", "hash").agg(F.count("*").alias("rows"))
    several = several.groupBy("term").agg(F.sum("rows").alias("n_c"), F.count("*").alias("texts")).where(f"texts >= {rules.texts}")
    entities = staged(several.select(F.col("term").alias("entity"), "n_c"), "entities", few)
    if entities.isEmpty():  # no term can be judged, so nothing needs counting
        return entities.select("entity", F.lit("").alias("term"), F.lit("").alias("action"))
    bits = rules.filter_bits
    known_entities = _bitmap(entities.select(F.col("entity").alias("term")), bits)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for rows, value, spans, names in zip(*(c.to_pylist() for c in batch.columns)):
                names = [c for c in names if _has(known_entities, _slot(c, bits))]
                if names:
                    places = terms(value, [(s["kind"], s["start"], s["end"]) for s in spans])
                    out.append((rows, names, sorted({value[a:b].lower() for a, b in places})))
            columns = list(zip(*out)) if out else [[], [], []]
            texts = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], texts), pa.array(columns[2], texts)], names=["rows", "entities", "terms"])

    firsts = held.join(alike.select("row", "rows"), "row").select("rows", "text", "spans", "entities")
    seen = staged(firsts.mapInArrow(tidy(whole), "rows long, entities array<string>, terms array<string>"), "seen-terms", files)
    support = seen.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("texts")).where(f"texts >= {rules.texts}")
    supported = _bitmap(support.select("term"), bits)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[str, str], list[int]] = {}
        for batch in batches:
            for rows, names, words in zip(*(c.to_pylist() for c in batch.columns)):
                words = [w for w in words if _has(supported, _slot(w, bits))]
                for name in names:
                    for word in words:
                        n = total.setdefault((name, word), [0, 0])
                        n[0] += rows
                        n[1] += 1
                    if len(total) > 200_000:
                        yield _paired(total)
                        total = {}
        yield _paired(total)

    counts = seen.mapInArrow(tidy(pairs), "entity string, term string, n long, texts long")
    counts = counts.groupBy("entity", "term").agg(F.sum("n").alias("n_ct"), F.sum("texts").alias("texts"))
    near = staged(counts.where(f"texts >= {rules.texts}"), "pair-counts", few)
    bitmap = _bitmap(near.select("term"), bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, bool] = {}
        total: Counter[str] = Counter()
        for batch in batches:
            for value in batch.column(0).to_pylist():
                words = set(TERM.findall(value.lower())) if value else ()
                for word in words:
                    hit = known.get(word)
                    if hit is None:
                        hit = known[word] = _has(bitmap, _slot(word, bits))
                    if hit:
                        total[word] += 1
            if len(known) > 500_000:
                known.clear()
            if len(total) > 200_000:
                yield _counted(total)
                total.clear()
        yield _counted(total)

    if near.isEmpty():  # no term can be judged, so nothing needs counting
        return near.select("entity", "term", F.lit("").alias("action"))
    totals = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(tidy(count), "term string, n long").groupBy("term").agg(F.sum("n").alias("n_t"))
    everything = docs.count()
    share = F.least(F.lit(1.0), F.col("n_ct") / F.greatest("n_t", "n_ct"))
    degree = 1 - F.log(share) / F.log((F.col("n_c") + 0.5) / (everything + 1))
    action = F.when(F.col("degree") >= rules.remove_at, ADDED[1]).when(F.col("degree") >= rules.generalise_at, ADDED[0])
    judged = near.join(totals, "term").join(entities, "entity").withColumn("degree", degree)
    return staged(judged.select("entity", "term", action.alias("action")).where("action is not null"), "disclosing", few)


def _entities(text: str, spans: str) -> Column:
    """The distinct entities of a row, as :func:`entity` names them."""

    @F.pandas_udf("array<string>")
    def named(values: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([sorted({entity(s["kind"], v[s["start"] : s["end"]]) for s in f}) for v, f in zip(values, found)], dtype=object)

    return named(text, spans)


def _paired(total: dict[tuple[str, str], list[int]]) -> pa.RecordBatch:
    names, words = [c for c, _ in total], [t for _, t in total]
    rows, texts = [n for n, _ in total.values()], [n for _, n in total.values()]
    columns = [pa.array(names, pa.string()), pa.array(words, pa.string()), pa.array(rows, pa.int64()), pa.array(texts, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["entity", "term", "n", "texts"])


def _counted(total: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["term", "n"])


def _class_of(word: str) -> str:
    return "[number]" if word.isdigit() else "[name]" if word[:1].isupper() else "[word]"


def clean(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text without its spans: base ones and generalised terms by their class, removed terms by nothing."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a < at:  # overlaps the one before
            at = max(at, b)
            continue
        out += [text[at:a], "" if kind == "removed" else _class_of(text[a:b]) if kind == "generalised" else f"[{kind}]"]
        at = b
    return "".join(out) + text[at:]


def sanitise(docs: DataFrame, rules: Disclosure = Disclosure(), text: str = "text", keep_text: bool = True) -> tuple[DataFrame, str]:
    """The rows with one struct column more, and that column's name: ``base`` and ``spans`` (arrays of kind, start, end)
    and the ``clean_text``. Without ``keep_text`` texts that have no span come back as null."""
    found, name = find(docs, text, keep_text)
    flagged = disclosing(found, docs, text, name, rules)
    bitmap, bits = _bitmap(flagged.select("term"), rules.filter_bits), rules.filter_bits
    column = free_name(docs, "personal_data")
    number, hashes, base = name["row_number_"], name["text_hash_"], name["base_spans_"]
    held = found.where(F.size(base) > 0).select(F.col(number).alias("row"), F.col(text).alias("text"), F.col(base).alias("spans"))

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sent(out: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.string(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)], names=["row", "entity", "term"])

        out: list[tuple] = []
        for batch in batches:
            for row, value, spans in zip(*(c.to_pylist() for c in batch.columns)):
                words = [w for w in set(TERM.findall(value.lower())) if _has(bitmap, _slot(w, bits))]
                for name in {entity(s["kind"], value[s["start"] : s["end"]]) for s in spans}:
                    for at in range(0, len(words), HELD):
                        out += [(row, name, word) for word in words[at : at + HELD]]
                        if len(out) >= HELD:
                            yield sent(out)
                            out = []
        yield sent(out)

    hits = held.mapInArrow(tidy(present), "row long, entity string, term string").join(flagged, ["entity", "term"])
    # Actions sort as wanted: the stronger one is the larger text.
    per_term = hits.groupBy("row", "term").agg(F.max("action").alias("action"))
    per_row = per_term.groupBy("row").agg(F.collect_list(F.struct("term", "action")).alias("terms")).select(F.col("row").alias(number), F.col("terms").alias(column))
    results = (("base_", SPANS), ("spans_", SPANS), ("clean_text_", T.StringType()))
    fields = [*docs.schema.fields, *(T.StructField(free_name(docs, f), kind) for f, kind in results)]

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            values, extra = batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
            bases = batch.column(batch.num_columns - 2).to_pylist()
            rows, texts = [], []
            for value, base_rows, chosen in zip(values, bases, extra):
                spans = [(s["kind"], s["start"], s["end"]) for s in base_rows]
                if chosen:
                    action = {t["term"]: t["action"] for t in chosen}
                    spans += [(action[w], a, b) for a, b in terms(value, spans) if (w := value[a:b].lower()) in action]
                order = KINDS + ADDED
                spans.sort(key=lambda s: (s[1], order.index(s[0])))
                rows.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
                texts.append(clean(value, spans) if spans else value)
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(rows, pa.list_(SPAN)), pa.array(texts, pa.string())], names=[f.name for f in fields])

    joined = found.drop(hashes).join(per_row, number, "left").drop(number)
    marked = joined.mapInArrow(tidy(mark), T.StructType(fields))
    own = [f.name for f in marked.schema.fields[-3:]]
    result = F.struct(F.col(own[0]).alias("base"), F.col(own[1]).alias("spans"), F.col(own[2]).alias("clean_text"))
    return marked.select(*[F.col(f"`{c}`") for c in docs.columns], result.alias(column)), column

