"""Segment files: reading with loop ids, and writing in order.

A segment file is one long line cut at a separator, so a segment's place is all that says
which group, transaction, family, member and coverage it belongs to. Spark reads such a file in
blocks. The counts that make the ids are taken inside each block, which is bounded by
``spark.sql.files.maxPartitionBytes``, by the task that reads it, and completed with the totals of
the blocks before it: one row per block. No task reads a whole file, and no segment is exchanged.

A file states its separators in its first segment, which is of fixed width. Each file's first bytes
are looked at, and files with the same separators are read together.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollkeep.sources.staging import staged

SEGMENT = "~"
ELEMENT = "*"
REPETITION = "^"
COMPONENT = ">"

# segments of the envelope around transactions
ENVELOPE_TAGS = ["ISA", "GS", "GE", "IEA"]
# segments that open (or, for SE, close) a part of a transaction
BOUNDARY_TAGS = ["ST", "INS", "HD", "SE"]
# more files than a task of Spark's writer ever makes
FILES_PER_PART = 1_000_000
# Length of the first segment with its separator, and the places of the separators in it.
ISA_LENGTH, AT_ELEMENT, AT_REPETITION, AT_COMPONENT, AT_SEGMENT = 106, 3, 82, 104, 105


def _sign(character: str) -> bool:
    return len(character) == 1 and not character.isalnum() and character not in " -."


@dataclass(frozen=True)
class Separators:
    """The four signs of a file."""

    segment: str = SEGMENT
    element: str = ELEMENT
    repetition: str = REPETITION
    component: str = COMPONENT

    def __post_init__(self) -> None:
        signs = (self.segment, self.element, self.repetition, self.component)
        if len(set(signs)) < 4 or not all(map(_sign, signs)):
            raise ValueError(f"these can't all be separators: {signs}")

    def own_text(self, text: str) -> str:
        """SQL of a text that was made with the usual signs, with these instead; where they stand in values they are blanked."""
        usual, own = SEGMENT + ELEMENT + REPETITION + COMPONENT, self.segment + self.element + self.repetition + self.component
        if own == usual:
            return text
        others = "".join(sign for sign in own if sign not in usual)
        return f"translate({text}, {_sql(usual + others)}, {_sql(own + ' ' * len(others))})"


def _sql(value: str) -> str:
    """A string as a SQL expression, by its characters' codes."""
    return "concat(" + ", ".join(f"chr({ord(c)})" for c in value) + ")"


USUAL = Separators()


def separators_of(start: str) -> Separators | None:
    """The signs that a file's first characters state; nothing if they are no such segment."""
    if len(start) < ISA_LENGTH or not start.startswith("ISA") or not _sign(start[AT_ELEMENT]):
        return None
    if len(start[:AT_SEGMENT].split(start[AT_ELEMENT])) != 17 or not _sign(start[AT_SEGMENT]):
        return None
    repetition = start[AT_REPETITION]  # in old versions a letter that names a standard
    signs = (start[AT_SEGMENT], start[AT_ELEMENT], repetition if _sign(repetition) else REPETITION, start[AT_COMPONENT])
    return Separators(*signs) if len(set(signs)) == 4 and _sign(signs[3]) else None


def _starts(spark: SparkSession, files: Sequence[str]) -> list[str]:
    """The first characters of each file, compressed ones too."""
    java = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    codecs = java.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def start(file: str) -> str:
        place = java.org.apache.hadoop.fs.Path(file)
        stream = place.getFileSystem(conf).open(place)
        try:
            codec = codecs.getCodec(place)
            stream = stream if codec is None else codec.createInputStream(stream)
            few = java.org.apache.commons.io.input.BoundedInputStream(stream, ISA_LENGTH)
            return java.org.apache.commons.io.IOUtils.toString(few, "ISO-8859-1")
        finally:
            stream.close()

    with ThreadPoolExecutor(16) as pool:
        return list(pool.map(start, files))


def _place_of(file: str) -> tuple[str, int, int]:
    """What a file belongs to (its folder ``interchange=N`` or itself), and its part and number there."""
    folder, _, name = file.rpartition("/")
    if not folder.rpartition("/")[2].startswith("interchange="):
        return file, 0, 0
    part, number = re.match(r"part-(\d+)", name), re.search(r"[.-]c(\d+)\.", name)
    return folder, int(part[1]) if part else 0, int(number[1]) if number else 0


def stated_separators(spark: SparkSession, path: str | Sequence[str]) -> dict[Separators, list[str]]:
    """Files and interchange folders by the separators that they state; the usual ones where none are stated.

    One small read per interchange, of its first file only.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    first: dict[str, tuple[int, int, str]] = {}
    for row in listed.collect():  # the names that reading them lists too
        owner, part, number = _place_of(row["path"])
        file = (part, number, row["path"])
        first[owner] = min(first.get(owner, file), file)
    owners = sorted(first)
    found: dict[Separators, list[str]] = {}
    for owner, start in zip(owners, _starts(spark, [first[o][2] for o in owners])):
        found.setdefault(separators_of(start) or USUAL, []).append(owner)
    return found


def _texts(spark: SparkSession, path: str | Sequence[str], separators: Separators | None) -> list[tuple[Separators, DataFrame]]:
    """By separators, the segments of the files that state them: ``path, block, row, text, tag``."""
    every = [path] if isinstance(path, str) else list(path)
    styles = {separators: every} if separators else stated_separators(spark, path)
    if len(styles) < 2:  # all alike: no need to name the files one by one
        styles = {style: every for style in styles or [USUAL]}
    return [(style, _styled_texts(spark, places, style)) for style, places in styles.items()]


def _styled_texts(spark: SparkSession, places: Sequence[str], style: Separators) -> DataFrame:
    raw = spark.read.option("lineSep", style.segment).option("recursiveFileLookup", True).text(list(places))
    broken = F.contains("value", F.lit("\r")) | F.contains("value", F.lit("\n"))  # few are, and translate looks at each character
    texts = raw.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.trim(F.when(broken, F.translate("value", "\r\n", "")).otherwise(F.col("value"))).alias("text"),
    )
    return texts.withColumn("tag", _element(style, 1)).where("tag <> ''")


def _element(style: Separators, number: int) -> Column:
    """The first or second element of a segment's text, empty if there is none. The others are not cut off."""
    first = F.substring_index("text", style.element, 1)
    value = first if number == 1 else F.substr(F.substring_index("text", style.element, 2), F.length(first) + 2)
    if (style.repetition, style.component) == (REPETITION, COMPONENT):
        return value
    return F.translate(value, style.repetition + style.component, REPETITION + COMPONENT)


def _elements(style: Separators) -> Column:
    elements = F.split("text", re.escape(style.element))
    if (style.repetition, style.component) == (REPETITION, COMPONENT):
        return elements
    # Inside an element every file's signs are the usual ones from here on; the first segment keeps what it states.
    usual = F.transform(elements, lambda x: F.translate(x, style.repetition + style.component, REPETITION + COMPONENT))
    return F.when(F.col("tag") == "ISA", elements).otherwise(usual)


def _placed(blocks: DataFrame, several: bool) -> DataFrame:
    """Add the ``file`` that a block's ``path`` belongs to and the number of its ``piece`` there. One row per block: for each
    segment the patterns would cost more than all else that reading does."""
    steps = F.split("path", "/")
    folder, name = F.element_at(steps, -2), F.element_at(steps, -1)
    written = folder.startswith("interchange=")
    run = F.regexp_replace("path", "/[^/]*$", "") if several else F.split(folder, "=")[1]
    number = F.regexp_extract(name, r"^part-(\d+)", 1).try_cast("long")
    count = F.regexp_extract(name, r"[.-]c(\d+)\.", 1).try_cast("long")
    place = F.coalesce(number, F.lit(0)) * FILES_PER_PART + F.coalesce(count, F.lit(0))
    return blocks.withColumns(
        {
            "file": F.when(written, run).otherwise(F.col("path")),
            "piece": F.when(written, place).otherwise(F.lit(0).cast("long")),
        }
    )


def _several(path: str | Sequence[str]) -> bool:
    return not isinstance(path, str) and len(path) > 1


def read_segments(spark: SparkSession, path: str | Sequence[str], separators: Separators | None = None) -> DataFrame:
    """Segments with their place: ``file, piece, block, row, elements, tag``, staged.

    ``file`` is the interchange: a folder ``interchange=N`` as the writer makes it, whose part
    files follow each other in the order of part and file number, or else a single file. With
    several paths an interchange goes by its folder's full path. Each file is cut by the separators
    that it states, unless they are handed in.
    """
    parts = [texts.select("path", "block", "row", _elements(style).alias("elements"), "tag") for style, texts in _texts(spark, path, separators)]
    segments = staged(reduce(DataFrame.unionAll, parts), "segments")
    blocks = staged(_placed(segments.select("path", "block").distinct(), _several(path)), "blocks")
    # one row per block
    return segments.join(F.broadcast(blocks), ["path", "block"]).select("file", "piece", "block", "row", "elements", "tag")


# what is counted, and what the segments after a segment are inside of until the next one with a value: the last segment of
# these tags, the code of the last name, and the place of the last member's first segment
_COUNTED = ("pos", "group_id", "txn_id", "family_id", "member_id", "coverage_id")
_RUNNING = ("within", "envelope", "party", "member_pos")
# numbers of the tags that are counted or carried; of these INS has another one for a subscriber
_KINDS = {tag: number for number, tag in enumerate([*ENVELOPE_TAGS, *BOUNDARY_TAGS, "NM1"], 1)}
_SUBSCRIBER = len(_KINDS) + 1
_COUNTED_SCHEMA = (
    "unit long, path string, block long, text string, "
    + "".join(f"_l_{name} long, " for name in _COUNTED)
    + "_here_within byte, _here_envelope byte, _here_party string, _here_member_pos long"
)


def _count_in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``path, block, row, text, kind, code`` with what :func:`_counted_in_block` adds. A block's rows come one after the
    other, in the order of the file, and all of them to one task; what they count up to is carried from batch to batch."""
    fields = ["unit", "path", "block", "text", *(f"_l_{n}" for n in _COUNTED), *(f"_here_{n}" for n in _RUNNING)]
    envelope, boundary = [_KINDS[t] for t in ENVELOPE_TAGS], [*(_KINDS[t] for t in BOUNDARY_TAGS), _SUBSCRIBER]
    counts, states, party, unit, open_at, waiting = [0] * len(_COUNTED), [0] * 3, None, None, None, None

    def finished(rows: dict, last: np.ndarray) -> pa.RecordBatch:
        at = pa.array(np.arange(len(last)), mask=~last)
        rows |= {"path": rows["path"].take(at), "block": rows["block"].take(at)}
        return pa.RecordBatch.from_arrays([rows[f] for f in fields], fields)

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        path, block, row = batch.column("path"), batch.column("block"), batch.column("row").to_numpy()
        kind = batch.column("kind").to_numpy()
        here = (path[0].as_py(), block[0].as_py())
        goes_on = here == open_at
        if waiting:
            waiting[1][-1] = not goes_on
            yield finished(*waiting)
        begins = np.ones(n, dtype=bool)
        same = pc.and_(pc.equal(path.slice(1), path.slice(0, n - 1)), pc.equal(block.slice(1), block.slice(0, n - 1)))
        begins[1:] = ~same.to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(begins)
        at = np.arange(n)
        start = np.maximum.accumulate(np.where(begins, at, 0))  # of each row's block in this batch
        carried = (start == 0) if goes_on else np.zeros(n, dtype=bool)
        units = row[start]
        if goes_on:
            units = np.where(carried, unit, units)

        is_member = (kind == _KINDS["INS"]) | (kind == _SUBSCRIBER)
        marks = (
            np.ones(n, dtype=bool), kind == _KINDS["GS"], kind == _KINDS["ST"], kind == _SUBSCRIBER, is_member, kind == _KINDS["HD"],
        )
        rows: dict = {"unit": pa.array(units), "path": path, "block": block, "text": batch.column("text")}
        for i, (name, mark) in enumerate(zip(_COUNTED, marks)):
            total = np.cumsum(mark, dtype=np.int64)
            total = total - (total[start] - mark[start]) + carried * counts[i]
            rows[f"_l_{name}"], counts[i] = pa.array(total), int(total[-1])

        def latest(mark: np.ndarray) -> np.ndarray:
            """The block's last marked row up to each row, or -1."""
            found = np.maximum.accumulate(np.where(mark, at, -1))
            return np.where(found >= start, found, -1)

        pos = rows["_l_pos"].to_numpy()
        of_boundary = np.isin(kind, boundary)
        tag_of = np.where(kind == _SUBSCRIBER, _KINDS["INS"], kind)
        for i, (name, mark, value) in enumerate(
            (("within", of_boundary, tag_of), ("envelope", np.isin(kind, envelope), tag_of), ("member_pos", is_member, pos))
        ):
            found = latest(mark)
            state = np.where(found >= 0, value[found], carried * states[i])
            states[i] = int(state[-1])
            kind_of = pa.int64() if name == "member_pos" else pa.int8()
            rows[f"_here_{name}"] = pa.array(state.astype(kind_of.to_pandas_dtype()), mask=state == 0)
        found = latest(of_boundary | (kind == _KINDS["NM1"]))
        codes = batch.column("code")
        values = pa.concat_arrays([pa.array([party], codes.type), codes])
        rows["_here_party"] = values.take(pa.array(found + 1, mask=(found < 0) & ~carried))
        if found[-1] >= 0 or not carried[-1]:
            party = rows["_here_party"][-1].as_py()

        last = np.zeros(n, dtype=bool)
        last[starts[1:] - 1] = True
        last[-1] = True  # unless the next batch goes on with the block
        waiting = (rows, last)
        open_at, unit = (path[-1].as_py(), block[-1].as_py()), int(units[-1])
    if waiting:
        yield finished(*waiting)


def _counted_in_block(texts: DataFrame, style: Separators) -> DataFrame:
    """Segments with the counts ``_l_`` and what they are inside of, ``_here_``, as far as their own block tells; the last of a
    block, and no other, has its ``path`` and ``block``; ``unit`` is the block's number. A block is read by one task in the order
    of the file, so that its rows need no exchange and no sort."""
    tag, code = F.col("tag"), _element(style, 2)
    kind = F.lit(0)
    for name, number in _KINDS.items():
        kind = F.when(tag == name, F.lit(number)).otherwise(kind)
    named = F.when(tag == "NM1", code).when(tag.isin(*BOUNDARY_TAGS), F.lit(""))
    rows = texts.select(
        "path", "block", "row", "text", F.when((tag == "INS") & (code == "Y"), F.lit(_SUBSCRIBER)).otherwise(kind).alias("kind"), named.alias("code")
    )
    return rows.mapInArrow(_count_in_blocks, _COUNTED_SCHEMA).withColumn("tag", _element(style, 1))


def looped_segments(spark: SparkSession, path: str | Sequence[str], separators: Separators | None = None) -> DataFrame:
    """The segments of files with ``pos`` (place in the file from 1) and the ids ``group_id``, ``txn_id``, ``family_id``,
    ``member_id`` and ``coverage_id``, running numbers per file, null for segments outside such a loop; ``party``, the
    code of the name (NM1) in whose loop a segment of a member stands, null before the first one; and ``member_pos``, the place
    of the member's first segment.

    The files are read once: what is known inside a block is staged, and a block's last segment says what the block holds.
    Texts are staged, which are smaller than their elements; a reader cuts those that it keeps.
    """
    styles = _texts(spark, path, separators)
    # units are numbered by style, and the rest of the number tells which
    counted = [
        _counted_in_block(texts, style).withColumn("unit", F.col("unit") * len(styles) + number)
        for number, (style, texts) in enumerate(styles)
    ]
    local = staged(reduce(DataFrame.unionAll, counted), "loops")
    earlier = Window.partitionBy("file").orderBy("piece", "block").rowsBetween(Window.unboundedPreceding, -1)
    totals = _placed(local.where("path is not null").drop("text", "tag"), _several(path))
    totals = totals.withColumn("_b_pos", F.coalesce(F.sum("_l_pos").over(earlier), F.lit(0)))
    totals = totals.withColumn("_here_member_pos", F.col("_here_member_pos") + F.col("_b_pos"))
    before = totals.select(
        "unit",
        "file",
        "_b_pos",
        *[F.coalesce(F.sum(f"_l_{name}").over(earlier), F.lit(0)).alias(f"_b_{name}") for name in _COUNTED[1:]],
        *[F.last(f"_here_{name}", ignorenulls=True).over(earlier).alias(f"_carried_{name}") for name in _RUNNING],
    )
    joined = local.join(F.broadcast(staged(before, "blocks")), "unit")  # one row per block
    joined = joined.withColumn("_here_member_pos", F.col("_here_member_pos") + F.col("_b_pos"))
    tag = F.col("tag")
    state = {name: F.coalesce(f"_here_{name}", f"_carried_{name}") for name in _RUNNING}
    outside = tag.isin(*ENVELOPE_TAGS)
    member = state["within"].isin(_KINDS["INS"], _KINDS["HD"]) & ~outside
    valid = {
        "pos": F.lit(True),
        "group_id": (state["envelope"] == _KINDS["GS"]) | (tag == "GE"),
        "txn_id": state["within"].isNotNull() & ~outside,
        "family_id": member,
        "member_id": member,
        "coverage_id": (state["within"] == _KINDS["HD"]) & ~outside,
    }
    elements = _elements(styles[-1][0])
    for number, (style, _) in enumerate(styles[:-1]):
        elements = F.when(F.col("unit") % len(styles) == number, _elements(style)).otherwise(elements)
    return joined.select(
        "file",
        "tag",
        elements.alias("elements"),
        *[F.when(valid[name], F.col(f"_l_{name}") + F.col(f"_b_{name}")).alias(name) for name in _COUNTED],
        F.when(member & (state["party"] != ""), state["party"]).alias("party"),
        F.when(member, state["member_pos"]).alias("member_pos"),
    )


class Segment:
    """One segment to write: its tag, its elements as SQL expressions over the row, and the
    condition under which it is there."""

    def __init__(self, tag: str, *elements: str, when: str = "true") -> None:
        self.tag, self.elements, self.when = tag, elements, when

    def text(self) -> str:
        """The segment as a SQL expression: nulls are empty, trailing empty elements are cut, and
        separator characters inside a value become blanks. Null when it is not there."""
        values = ", ".join(f"coalesce(cast({x} as string), '')" for x in self.elements)
        clean = f"translate(concat_ws(chr(1), '{self.tag}', {values}), concat('*~>^', chr(1)), '    *')"
        text = f"trim(trailing '*' from {clean})"
        return text if self.when == "true" else f"case when {self.when} then {text} end"

    def fields(self) -> str:
        """Tag and elements as a SQL array. Null when the segment is not there."""
        values = ", ".join(f"cast({x} as string)" for x in self.elements)
        return f"case when {self.when} then array('{self.tag}', {values}) end"


class Named(Segment):
    """A segment whose elements as read may be in the map ``own_segments`` under ``name``.

    A column that still says what was read gives the element as read, and so do elements without a column; a changed column
    is written as :class:`Segment` does. ``read``: place of a column's element, the column, and the SQL of what reading
    makes of the element ``{raw}``. ``along``: places of qualifiers, and of the column that they go with. ``rest``: SQL of
    the elements after the last place.
    """

    def __init__(
        self,
        name: str,
        tag: str,
        *elements: str,
        when: str = "true",
        read: dict[int, tuple[str, str]] | None = None,
        along: dict[int, int] | None = None,
        rest: str | None = None,
    ) -> None:
        super().__init__(tag, *elements, when=when)
        self.name, self.new = name, Segment(tag, *elements, when=when)  # new: the segment of a row that was never read
        self.raw, self.read, self.along = f"own_segments['{name}']", read or {}, along or {}
        after = f"slice({self.raw}, {len(elements) + 2}, greatest(size({self.raw}) - {len(elements) + 1}, 0))"
        self.rest = rest or after
        if when != "true":
            held = f"exists({after}, x -> x <> '')"
            self.when = f"({when} or coalesce({self._unchanged()} or ({self.raw} is not null and {held}), false))"

    def _unchanged(self) -> str:
        """Was read, and every column still says so."""
        return "(" + " and ".join([f"{self.raw} is not null", *(self._same(place) for place in self.read)]) + ")"

    def _same(self, place: int) -> str:
        column, as_read = self.read[place]
        return f"{column} <=> {as_read.format(raw=f'get({self.raw}, {place})')}"

    def _kept(self) -> str:
        """The elements after the tag as a SQL array, where the segment was read."""
        out = []
        for place, x in enumerate(self.elements, 1):
            raw = f"translate(get({self.raw}, {place}), concat('*~', chr(1)), '  *')"
            decides = self.along.get(place, place)
            if decides in self.read:
                own = f"translate(cast({x} as string), concat('*~>^', chr(1)), '    *')"
                raw = f"case when {self._same(decides)} then {raw} else {own} end"
            out.append(f"coalesce({raw}, '')")
        rest = f"transform({self.rest}, x -> translate(coalesce(x, ''), concat('*~', chr(1)), '  *'))"
        return f"concat(array({', '.join(out)}), {rest})"

    def text(self) -> str:
        # most segments are as they were read: these need no look at each element
        whole = f"trim(trailing '*' from {_cleaned(self.raw)})"
        kept = f"trim(trailing '*' from concat_ws('*', '{self.tag}', {self._kept()}))"
        other = f"case when {self.raw} is null then {Segment(self.tag, *self.elements).text()} else {kept} end"
        return f"case when {self._unchanged()} then {whole} when {self.when} then {other} end"

    def fields(self) -> str:
        new = Segment(self.tag, *self.elements).fields()
        both = f"case when {self.raw} is null then {new} else concat(array('{self.tag}'), {self._kept()}) end"
        return f"case when {self.when} then {both} end"


def _cleaned(elements: str) -> str:
    """SQL of a text of elements that were read, which may hold the inner separators. Few do, and replacing looks for them only."""
    return f"replace(replace(replace(array_join({elements}, chr(1), ''), '*', ' '), '~', ' '), chr(1), '*')"


def joined(*segments: Segment, others: str | None = None, order: str | None = None) -> str:
    """The segments that are there, as one text, and those of a column of element arrays.

    ``order``: a column with the names of the segments as they were read, and ``#`` for each of ``others``; they go back to
    their places. A segment that was not read goes after one of its own tag, else before the next of the segments in the
    order given here, else after the one before it. Rows without an order have ``segments`` and then ``others``.
    """
    texts = [s.text() for s in segments]
    if others is None:
        return f"concat_ws('{SEGMENT}', {', '.join(texts)})"
    rest = f"transform({others}, x -> trim(trailing '*' from {_cleaned('x')}))"
    if order is None:
        return f"concat_ws('{SEGMENT}', {', '.join(texts)}, {rest})"
    places = ", ".join(_place(segments, j) for j in range(len(segments)))
    names = ", ".join(f"'{s.name}'" for s in segments)
    order = f"coalesce({order}, concat(array({names}), array_repeat('#', coalesce(size({others}), 0))))"
    read_at = f"array(transform(array({names}), n -> nullif(array_position({order}, n), 0)))"
    # Only the small parts stand in functions with lambdas, whose arguments Spark does not compile; the texts do not.
    named = f"arrays_zip(get(transform({read_at}, p -> array({places})), 0), array({', '.join(texts)}))"
    kept_at = f"filter(transform({order}, (x, i) -> case when x = '#' then cast(i as bigint) * {STEP} end), k -> k is not null)"
    pair = f"named_struct('0', coalesce(k, {STEP * STEP}), '1', t)"
    kept = f"zip_with({kept_at}, coalesce({rest}, cast(array() as array<string>)), (k, t) -> {pair})"
    # segments that are not there are null, which concat_ws leaves out
    return f"concat_ws('{SEGMENT}', sort_array(concat({named}, {kept})).`1`)"


STEP = 1_000_000  # more than there are segments to go between two that were read


def _place(segments: Sequence[Segment], j: int) -> str:
    """SQL of where segment ``j`` goes, given in ``p`` the places (from 1) of those that were read."""

    def nearest(some: Sequence[int], shift: int) -> str:
        listed = ", ".join(f"get(p, {k})" for k in some)
        return f"(coalesce({listed}, null) - 1) * {STEP} + {shift}" if some else "cast(null as bigint)"

    earlier, later = list(range(j - 1, -1, -1)), list(range(j + 1, len(segments)))
    alike = [k for k in earlier if segments[k].tag == segments[j].tag]
    choices = [nearest([j], 0), nearest(alike, j + 1), nearest(later, j - STEP // 2), nearest(earlier, j + 1), str(j)]
    return f"cast(coalesce({', '.join(choices)}) as bigint)"


def number_of(*segments: Segment) -> Column:
    """How many of the segments are there, without building them."""
    return F.expr(" + ".join(f"case when {s.when} then 1 else 0 end" for s in segments))


def fields_of(*segments: Segment) -> Column:
    """The segments that are there, as an array of element arrays."""
    return F.expr(f"array_compact(array({', '.join(s.fields() for s in segments)}))")


DATE = "try_to_date(nullif({raw}, ''), 'yyyyMMdd')"


def dated(tag: str, qualifier: str, column: str) -> Segment:
    """A fixed day; one that was read in another form is kept as it is while the column is as read."""
    return Named(
        f"{tag}|{qualifier}", tag, f"'{qualifier}'", "'D8'", f"date_format({column}, 'yyyyMMdd')",
        when=f"{column} is not null", read={3: (column, DATE)}, along={2: 3},
    )


def write_segments(
    rows: DataFrame,
    path: str,
    order: Sequence[str],
    value: str,
    separators: Separators = USUAL,
    part: tuple[str, int] | None = None,
) -> None:
    """Write one text per row, a SQL expression of one or more joined segments, in the given
    order, one folder per ``interchange``.

    ``part``: a column with the number of the partition that a row goes to, rising in the order, and how many
    there are. Without it the rows are range partitioned on the order, for which they are evaluated twice. Either way an
    interchange of any size is spread over as many tasks as it needs; its part files in number order are the file. The
    texts are made after the exchange, from rows that are smaller than they are.
    """
    columns = ["interchange", *order]
    placed = rows.repartitionById(part[1], F.col(part[0])) if part else rows.repartitionByRange(*columns)
    texts = placed.sortWithinPartitions(*columns).select("interchange", F.expr(separators.own_text(value)).alias("value"))
    texts.write.partitionBy("interchange").option("lineSep", separators.segment).text(path)


def archive_segments(spark: SparkSession, path: str, target: str) -> None:
    """Keep a bzip2 copy of a written file or folder, interchange by interchange, in the same order and with the usual signs."""
    segments = read_segments(spark, path)
    short = F.element_at(F.split("file", "/"), -1)
    # The first segment states the copy's signs, not the file's.
    stated = F.transform("elements", lambda x, i: F.when(i == 11, REPETITION).when(i == 16, COMPONENT).otherwise(x))
    elements = F.when(F.col("tag") == "ISA", stated).otherwise(F.col("elements"))
    rows = segments.select(short.alias("interchange"), "piece", "block", "row", F.concat_ws(ELEMENT, elements).alias("value"))
    columns = ["interchange", "piece", "block", "row"]
    placed = rows.repartitionByRange(*columns).sortWithinPartitions(*columns).select("interchange", "value")
    placed.write.partitionBy("interchange").option("lineSep", SEGMENT).option("compression", "bzip2").text(target)
