"""The filter audit, the web archive and the fill-in-the-middle transformation, against plain Python."""

import base64
import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from brute import WORDS
from fixtures import table, texts
from pyspark.sql import functions as F

from rollkeep.llm import fill_in_middle, filter_audit, web_archive

ROWS = texts()
HUGE = (1 << 62) + 1  # an id that a float does not hold


def bag(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- filter audit ---------------------------------------------------------------------------------


def own_mask(text):
    words = WORDS.findall(text)
    capitals = sum("A" <= c <= "Z" for c in text)
    tests = [len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * capitals > 5 * len(text), bool(re.search(r"[#$%&*|]", text))]
    return sum(failed << k for k, failed in enumerate(tests))


def audited(rows, labels):
    """Every order applied step by step to the rows (doc_id, text, source)."""
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    masks = [own_mask(t or "") + 16 * (i is not None and i > least[t or ""]) for i, t, _ in rows]
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    parts = defaultdict(list)
    for (i, _, s), m in zip(rows, masks):
        parts[s or ""].append((i, m))
    out, removed_by = {}, Counter()
    for part, of in parts.items():
        for order in itertools.permutations("ABCDE"):
            left = list(of)
            for step, letter in enumerate(order):
                bit = 1 << "ABCDE".index(letter)
                gone = [(i, m) for i, m in left if m & bit]
                failing = sum(1 for _, m in of if m & bit)
                left = [(i, m) for i, m in left if not m & bit]
                alone = sum(1 for _, m in of if m == bit)
                lost = [sum(i in known for i, _ in gone) for known in (good, toxic)]
                out[part, "".join(order), step + 1] = (len(left), len(gone), failing - len(gone), alone, *lost)
                removed_by[part, letter] += len(gone)
    return [(*key, *value, removed_by[key[0], key[1][key[2] - 1]]) for key, value in out.items()]


def audit_rows():
    rng = random.Random(7)
    rows = [(i, t, rng.choice(["hot", "cold", None, ""])) for i, t in ROWS]
    rows += [(HUGE + k, "the same text again and again", "hot") for k in range(40)] + [(HUGE, "the same text again and again", "cold")]
    rows += [(None, "one", "hot"), (None, "of no id", "hot"), (None, "of no id", None), (3, "CAPITALS ONE", "new"), (9, "CAPITALS ONE", "new")]
    return rows


LABELS = [(3, 1, 0), (3, 0, 1), (9, None, None), (101, 1, 1), (HUGE, 0, 1), (None, 1, 1), (400, 1, 0), (HUGE + 5, 1, 0)]


@pytest.mark.parametrize(
    "rule",
    [filter_audit.Sketch(), filter_audit.Sketch(slice_texts=16, group_rows=4, flush=10), filter_audit.Sketch(counters=1, hashes=1)],
    ids=["plain", "many slices", "every counter shared"],
)
def test_audit(spark, rule):
    rows = audit_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({c: F.lit("taken") for c in ("mask", "hash", "digest", "row", "part")})
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").withColumn("part", F.lit("taken"))
    got = filter_audit.audit(docs, labels, rule=rule)
    assert got.columns[:3] == ["part", "filter_order", "step"]
    assert bag(got.collect()) == bag(audited(rows, LABELS))
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert filter_audit.audit(none, labels, rule=rule).count() == 0
    assert filter_audit.audit(docs, labels.limit(0), rule=rule).agg(F.sum("good_lost") + F.sum("toxic_lost")).first()[0] == 0


def test_only_possible_repeats_keep_their_digest(spark):
    rows = [(i, f"text number {i}", "s") for i in range(4000)] + [(5000 + i, "text number 7", "s") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = filter_audit.tested(filter_audit.facts(docs, "source"), filter_audit.Sketch(slice_texts=1000, group_rows=200))
    assert found.count() == len(rows)
    possible = {r["doc_id"] for r in found.where("digest is not null").select("doc_id").collect()}
    assert possible >= {7} | set(range(5000, 5500))
    assert len(possible) - 501 < 400  # a counter in eight, three times


def test_a_frequent_text_is_one_entry_of_a_tasks_counts():
    import numpy as np

    hashes = np.array([42] * 100_000 + list(range(10)), dtype=np.uint64)
    parts = list(filter_audit.partial_counts(hashes, 4, 1024, 3))
    assert sum(len(once) + len(more) for _, once, more in parts) <= 11 * 3 * 4


# --- web archive ----------------------------------------------------------------------------------


def pages():
    rng = random.Random(3)
    rows = [(i, f"http://a.example/{i}", f"<p>{rng.random()}</p>" * rng.randint(0, 400)) for i in range(40)]
    rows += [(100 + i, "http://b.example/\n\tx y", "<p>copied</p>") for i in range(60)]
    rows += [(200, None, None), (201, "u", ""), (202, None, ""), (None, "n", "<p>copied</p>"), (None, "n", "only here"), (None, "n", "only here")]
    rows += [(159, "http://b.example/again", "<p>copied</p>"), (7, "again", "<p>copied</p>"), (300, "é", "WARC/1.1\r\n\x1f\x8b\x08é\U0001f600")]
    return rows + [(HUGE, "big", "z" * 300_000), (HUGE + 1, "big", "z" * 300_000), (301, "late", "z" * 300_000)]


def archived(rows, least=0):
    largest = {}
    for i, _, html in rows:
        if i is not None:
            largest[html or ""] = max(i, largest.get(html or "", i))
    out = []
    for i, _, html in rows:
        data, most = (html or "").encode(), largest.get(html or "")
        first = most is None or i == most or len(data) < least
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "response" if first else "revisit", None if first else most))
    return out


@pytest.mark.parametrize("least", [0, 10])
def test_pages_come_back_from_their_archives(spark, tmp_path, least):
    rows = pages()
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("taken") for c in ("payload", "largest", "same", "file", "start")})
    files = web_archive.write(frame, f"file://{tmp_path}/warc", least_bytes=least, shard_bytes=20_000)
    assert files.agg(F.sum("n_records")).first()[0] == len(rows)
    found = web_archive.read(spark, files)
    assert web_archive.gaps(found).count() == 0
    got = web_archive.pages_of(found)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert bag(got.collect()) == bag(archived(rows, least))
    none = web_archive.write(frame.limit(0), f"file://{tmp_path}/none")
    assert web_archive.pages_of(web_archive.read(spark, none)).count() == 0


DATE = "2024-01-01T00:00:00Z"


def own_records():
    rng = random.Random(11)
    out = [web_archive.information("x", DATE)]
    for i in range(40):
        # payloads hold the marks that a salvage looks for
        payload = rng.randbytes(rng.randint(0, 2500)) + b"WARC/1.1\r\n\x1f\x8b\x08" * rng.randint(0, 3)
        out.append(web_archive.page_record(i, f"http://a.example/{i}", payload, None, False, DATE))
    return [*out, web_archive.page_record(77, "u", b"", 5, True, DATE)]


def harmed(data, rng):
    kind, at = rng.choice(["flip", "cut", "zero", "junk", "gone", "length"]), rng.randrange(len(data))
    if kind == "flip":
        return data[:at] + bytes([data[at] ^ rng.randrange(1, 256)]) + data[at + 1 :]
    if kind == "cut":
        return data[:at]
    if kind == "zero":
        return data[:at] + bytes(len(data[at : at + 30])) + data[at + 30 :]
    if kind == "length":
        return data.replace(b"Content-Length: ", b"Content-Length: 9", 1)
    return data + rng.randbytes(60) if kind == "junk" else b""


@pytest.mark.parametrize("packed", [True, False], ids=["members", "plain"])
def test_salvage_loses_the_damaged_records_only(packed):
    rng, records = random.Random(5), own_records()
    parts = [web_archive.member(r) if packed else r for r in records]
    named = [re.search(rb"WARC-Record-ID: (\S+)", r)[1].decode() for r in records]
    whole = list(web_archive.salvage(pa.BufferReader(b"".join(parts))))
    assert [x.headers["warc-record-id"] for x in whole] == named
    for _ in range(150):
        hit = set(rng.sample(range(len(parts)), rng.randint(1, 4)))
        data = b"".join(harmed(p, rng) if k in hit else p for k, p in enumerate(parts))
        found = list(web_archive.salvage(pa.BufferReader(data)))
        ids = [x.headers["warc-record-id"] for x in found if isinstance(x, web_archive.Record)]
        assert set(ids) >= {n for k, n in enumerate(named) if k not in hit}
        # Headers have no digest of their own: without members, a letter that changed in one goes unnoticed.
        assert [i for i in ids if i in named or packed] == [n for n in named if n in set(ids)]
        ends = [0, *(x.end for x in found)]
        assert [x.start for x in found] == ends[:-1] and ends[-1] == len(data)  # every byte is a record's or a gap's
    assert list(web_archive.salvage(pa.BufferReader(b""))) == []
    junk = list(web_archive.salvage(pa.BufferReader(rng.randbytes(5000) + parts[3] + b"\0" * 9)))
    assert [type(x).__name__ for x in junk] == ["Gap", "Record", "Gap"] and junk[2].end - junk[2].start == 9


def test_damaged_files_are_read_and_logged(spark, tmp_path):
    rows = pages()
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    files = web_archive.write(frame, f"file://{tmp_path}/warc", shard_bytes=20_000)
    found = web_archive.read(spark, files)
    hit = found.where("page_id in (3, 159, 20)").select("file", "start", "end", "page_id").collect()
    for r in hit:
        name = r["file"].removeprefix("file://")
        data = bytearray(open(name, "rb").read())
        data[(r["start"] + r["end"]) // 2] ^= 0xFF
        open(name, "wb").write(data)
    again = web_archive.read(spark, files)
    assert bag(web_archive.gaps(again).select("file", "start", "end").collect()) == bag(r[:3] for r in hit)
    assert all(r["reason"] for r in web_archive.gaps(again).collect())
    got = {tuple(r) for r in web_archive.pages_of(again).collect()}
    kept = {r for r in archived(rows) if r[0] not in (3, 159, 20) and r[2] != archived(rows)[45][2]}
    assert got >= kept
    lost = [r for r in got if r[3] == "revisit" and r[4] is None]  # their response is one of the damaged ones
    assert lost and {r[1] for r in lost} == {None}


# --- fill in the middle ---------------------------------------------------------------------------

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def middle(doc_id, text):
    text = text or ""
    units = UNITS.findall(text)
    n, digest = len(units), sha(f"42:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, inner, suffix = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return (doc_id, n, "plain", None, None, sha(text), sha(text)), text
    form = "spm" if h[3] % 100 < 80 else "psm"
    out = f"<S>{suffix}<P>{prefix}<M>{inner}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{inner}"
    return (doc_id, n, form, len(prefix), len(inner), sha(out), sha(text)), out


def middle_rows():
    rng = random.Random(9)
    parts = ["a", "é", " ", "\n", " ", "<", "P", ">", "\U0001f600", "bc", "\x1c", "<P", "M>", "\t\t"]
    odd = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    rows = [*ROWS, *((HUGE + k, t) for k, t in enumerate(odd)), (500, "has <P> inside"), (501, "and <M>"), (502, "   "), (503, "x" * 200_000)]
    return rows + [(600 + k, ROWS[-6][1] + f" {k}\n") for k in range(8)]


@pytest.mark.parametrize("size", [1 << 16, 7, 1000])
def test_fill_in_middle(spark, size):
    rows, rule = middle_rows(), fill_in_middle.FillInMiddle(frame_bytes=size)
    docs = table(spark, rows).withColumns({c: F.lit("taken") for c in ("marked", "n", "units", "chars", "frames", "form")})
    stored = fill_in_middle.stored_frames(docs, rule)
    got = fill_in_middle.fill_in_middle(stored, rule).collect()
    expected = [middle(*r) for r in rows]
    assert bag(got) == bag(r for r, _ in expected)
    assert {r["form"] for r in got} == {"plain", "spm", "psm"}
    assert bag(fill_in_middle.outputs(stored, rule).collect()) == bag((r[0], r[2], out) for r, out in expected)
    assert fill_in_middle.fill_in_middle(fill_in_middle.stored_frames(docs.limit(0), rule), rule).count() == 0


def test_a_cut_opens_one_frame_only():
    import zstandard

    press, unpress = zstandard.ZstdCompressor().compress, zstandard.ZstdDecompressor().decompress
    data = " ".join(f"word{k}" for k in range(5000)).encode()
    parts = list(fill_in_middle.sections(data, 1000))
    units = list(itertools.accumulate(map(fill_in_middle.units_of, parts)))
    chars = list(itertools.accumulate(map(fill_in_middle.code_points, parts)))
    opened = []

    def seen(frame):
        opened.append(frame)
        return unpress(frame)

    text = fill_in_middle.StoredText(units, chars, [press(p) for p in parts], seen)
    place, before = text.cut(2500)
    assert len(opened) == 1 and before == len(" ".join(f"word{k}" for k in range(2500)))
    assert b"".join(text.between((0, 0), place)) == data[:before]
    assert len(parts) > 40 and b"".join(text.between((0, 0), (len(parts), 0))) == data
