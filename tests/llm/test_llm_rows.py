"""Operators on single rows and token operators, against plain Python and the libraries."""

import base64
import hashlib
import random
import zlib

import brute
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
from fixtures import table, texts
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rollkeep.llm import blob_ledger, byte_pairs, disclosure, encoders, harmonic, line_rules, token_counts, token_frames, weak_labels

WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
BYTE_FILE = public_tokenizers.path("byte_bpe_50k.json")
RANK_FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ROWS = texts()


def bag(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def sha(data):
    return hashlib.sha256(data).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark)


@pytest.fixture(scope="module")
def none(spark):
    return table(spark, [])


def test_line_rules(docs, none):
    checked, name = line_rules.with_line_rules(docs)
    assert name != "line_rules" and checked.columns == [*docs.columns, name]
    base = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed".split()
    got = checked.select("doc_id", *[F.col(f"{name}.{c}") for c in base]).collect()
    assert bag(got) == bag((i, *brute.line_base(t)) for i, t in ROWS)
    one = checked.where("doc_id = 409").select(f"{name}.*").first()
    assert one["n_failed_lines"] == 2 and one["kept"] and "Home" not in one["clean_text"] and "Good lines" in one["clean_text"]
    kept = line_rules.cleaned(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} >= {100, 409}
    assert line_rules.with_line_rules(none)[0].count() == 0


def test_a_document_that_loses_most_lines_goes(spark):
    lines = "Home | News | Contact us today\n" * 30 + "A line of words that is fine by itself and is much the shortest part here."
    checked, name = line_rules.with_line_rules(spark.createDataFrame([(1, lines)], "doc_id long, text string"))
    found = checked.select(f"{name}.*").first()
    assert not found["kept"] and found["n_failed_lines"] == 30


def test_secrets_and_their_ledger(spark, docs, none, tmp_path):
    folder = str(tmp_path / "ledger")
    found = blob_ledger.scan(docs, folder)
    sizes = [F.size(r.kind).cast("long") for r in blob_ledger.BASE]
    digest = F.sha2(blob_ledger.described(blob_ledger.BASE), 256)
    assert bag(found.select("doc_id", *sizes, digest).collect()) == bag((i, *brute.secrets(t)) for i, t in ROWS)
    pairs = spark.read.parquet(f"{folder}/ledger").count()
    assert pairs == len({t or "" for _, t in ROWS}) * len(blob_ledger.RULES)
    # Known blobs are not scanned again; a new version of a path and a new version of a rule are.
    more = table(spark, [*ROWS, (1, "password=letmein99")])
    again = blob_ledger.scan(more, folder)
    assert bag(again.where("doc_id = 1").select(F.size("assign")).collect()) == [(0,), (1,)]
    assert spark.read.parquet(f"{folder}/ledger").count() == pairs + len(blob_ledger.RULES)
    newer = (blob_ledger.Rule("access", r"AKIA[A-Z]+", version=2, least=20), *blob_ledger.RULES[2:])
    blob_ledger.scan(more, folder, newer)
    assert spark.read.parquet(f"{folder}/ledger").count() == pairs + len(blob_ledger.RULES) + len({t or "" for _, t in ROWS}) + 1
    assert blob_ledger.scan(none, str(tmp_path / "empty")).count() == 0


def test_thousands_of_matches_in_one_text(spark, tmp_path):
    many = " ".join(f"token={i:07d}" for i in range(100_000))
    found = blob_ledger.scan(spark.createDataFrame([(1, many), (2, "token=abcdef")], "doc_id long, text string"), str(tmp_path / "many"))
    rows = {r["doc_id"]: r["assign"] for r in found.select("doc_id", "assign").collect()}
    assert len(rows[1]) == 100_000 and [(s["start"], s["end"]) for s in rows[1][-2:]] == [(14 * 99_998, 14 * 99_998 + 13), (14 * 99_999, 14 * 99_999 + 13)]
    assert len(rows[2]) == 1


def test_boilerplate_of_four_languages(spark):
    lines = ["Bitte lesen Sie unsere Datenschutzerklärung hier.", "TOUS DROITS RÉSERVÉS par nous.", "Haga clic aquí para ver más.", "All  rights reserved by us."]
    clean = ["Die Erklärung war lang und gut.", "Les droits sont les mêmes.", "La política es otra cosa.", "All rights of way."]
    checked, name = line_rules.with_line_rules(spark.createDataFrame([(1, "\n".join([*lines, *clean]))], "doc_id long, text string"))
    one = checked.select(f"{name}.*").first()
    assert one["n_failed_lines"] == 4 and one["clean_text"].split("\n") == clean


def test_many_terms_with_many_entities(spark, monkeypatch):
    monkeypatch.setattr(disclosure, "HELD", 7)
    rng = random.Random(3)
    plain = [(i, " ".join(rng.choice("alpha beta gamma delta".split()) for _ in range(30))) for i in range(300)]
    told = [(1000 + i, f"alpha {i} beta Zorkmid ann@mail.example bob@mail.example gamma Quillon {i}") for i in range(6)]
    marked, name = disclosure.sanitise(spark.createDataFrame(plain + told, "doc_id long, text string"))
    texts = {r["doc_id"]: r[name]["clean_text"] for r in marked.collect()}
    assert all("Zorkmid" not in texts[1000 + i] and "Quillon" not in texts[1000 + i] for i in range(6))


def test_personal_data(docs, none):
    marked, name = disclosure.sanitise(docs)
    assert marked.columns == [*docs.columns, name]
    rows = marked.select("doc_id", F.col(f"{name}.base").alias("b"), F.col(f"{name}.clean_text").alias("c"), "text").collect()
    got = []
    for r in rows:
        spans = [(s["start"], s["kind"], s["end"]) for s in r["b"]]
        n = [sum(k == kind for _, k, _ in spans) for kind in disclosure.KINDS]
        got.append((r["doc_id"], *n, sha(brute.described(spans, disclosure.KINDS).encode())))
        assert spans or r["c"] == r["text"]
        assert not spans or "mail.example.org" not in r["c"]
    assert bag(got) == bag((i, *brute.personal(t)) for i, t in ROWS)
    assert disclosure.sanitise(none)[0].count() == 0


def test_terms_that_give_an_entity_away(spark):
    rng = random.Random(3)
    plain = [(i, " ".join(rng.choice("alpha beta gamma delta".split()) for _ in range(30))) for i in range(300)]
    told = [(1000 + i, f"alpha {i} beta Zorkmid ann@mail.example gamma {i}") for i in range(6)]
    marked, name = disclosure.sanitise(spark.createDataFrame(plain + told, "doc_id long, text string"))
    rows = {r["doc_id"]: r[name] for r in marked.collect()}
    assert "Zorkmid" not in rows[1000]["clean_text"] and "ann@" not in rows[1000]["clean_text"]
    assert "alpha" in rows[1000]["clean_text"]  # a common word gives nothing away
    assert all(not rows[i]["spans"] for i, _ in plain)
    assert {s["kind"] for s in rows[1000]["spans"]} == {"email", "removed"}


def test_terms_far_from_an_entity_give_it_away_too(spark):
    rng = random.Random(5)
    far = lambda: " ".join(rng.choice("alpha beta gamma delta".split()) for _ in range(30))
    plain = [(i, far()) for i in range(300)]
    told = [(1000 + i, f"Quillfeather {far()} ann@mail.example {far()} Zorkmid") for i in range(6)]
    # near in some rows, far in others; in one text only, however often; with an entity of two texts only
    told += [(2000 + i, f"bob@mail.example {far() if i % 2 else ''} Brandle") for i in range(6)]
    told += [(3000 + i, "cyd@mail.example alpha Once") for i in range(6)] + [(4000 + i, f"dot@mail.example Twice {far()}") for i in range(2)]
    marked, name = disclosure.sanitise(spark.createDataFrame(plain + told, "doc_id long, text string"))
    texts = {r["doc_id"]: r[name]["clean_text"] for r in marked.collect()}
    assert all("Quillfeather" not in texts[1000 + i] and "Zorkmid" not in texts[1000 + i] for i in range(6))
    assert all("Brandle" not in texts[2000 + i] for i in range(6))
    assert "Once" in texts[3000] and "Twice" in texts[4000] and "alpha" in texts[1000]


def test_byte_pairs_equal_the_library(spark, docs, none):
    ranks = byte_pairs.ranks_of(RANK_FILE)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(7)
    signs = [*"asxtmdrevl'  \n\t.,!1²é漢̈", "'s", "'re", "'ll", "　", " ", "\r\n", "\x1c", "\x85", "\U0001f600"]
    odd = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(20_000)]
    assert byte_pairs.coder(RANK_FILE).encode(odd) == [library.encode_ordinary(t) for t in odd]
    got = byte_pairs.round_trip(docs, RANK_FILE).collect()
    expected = []
    for i, t in ROWS:
        ids = library.encode_ordinary(t or "")
        expected.append((i, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())))
    assert bag(got) == bag(expected)
    some = docs.where("doc_id in (406, 409, 2)")
    encoded = byte_pairs.encode(some, RANK_FILE)
    decoded = {r["doc_id"]: bytes(r["data"]).decode() for r in byte_pairs.decode(encoded, RANK_FILE).collect()}
    assert decoded == {i: t or "" for i, t in ROWS if i in (406, 409, 2)}
    assert byte_pairs.round_trip(none, RANK_FILE).count() == 0


def test_offsets_find_a_part_of_a_text():
    pairs, rng = byte_pairs.coder(RANK_FILE), random.Random(2)
    text = "".join(rng.choice(["word ", "é", "漢字", "12", "\n", "\U0001f600"]) for _ in range(3000))
    ids, data = pairs.encode([text])[0], text.encode()
    ends = pairs.ends(ids)
    assert ends[-1] == len(data) and b"".join(pairs.decode(ids, ends, 100)) == data
    for _ in range(200):
        a, b = sorted(rng.sample(range(len(data) + 1), 2))
        assert pairs.between(np.array(ids), ends, a, b) == data[a:b]
    wrong = ends.copy()
    wrong[10:] += 1
    with pytest.raises(ValueError):
        b"".join(pairs.decode(ids, wrong))
    assert list(pairs.decode([], np.empty(0, dtype=np.int64))) == []


def test_merges_of_long_pieces():
    ranks = byte_pairs.ranks_of(RANK_FILE)
    for piece in (b"a" * 3000, b"ab" * 700, bytes(range(256)) * 3):
        assert byte_pairs.merge(piece, ranks) == byte_pairs._merge_short(piece, ranks) or piece in ranks


def library_ids(path, rows):
    return [e.ids for e in Tokenizer.from_file(path).encode_batch([t or "" for _, t in rows], add_special_tokens=False)]


def test_words_encode_alone_as_in_their_text():
    rng = random.Random(9)
    signs = [*"aAbJ'  \n.,!12éΣİ̌́", "'S", "<|endoftext|>", "<|ENDOFTEXT|>", "　", "\x1c"]
    odd = [(0, "".join(rng.choice(signs) for _ in range(rng.randint(0, 25)))) for _ in range(5000)]
    encode, count = encoders.word_encoder(WORD_FILE), encoders.word_counter(WORD_FILE)
    expected, values = library_ids(WORD_FILE, odd), [t for _, t in odd]
    assert [np.frombuffer(b, dtype="<u4").tolist() for b in encode(values)] == expected and count(values) == list(map(len, expected))
    assert encode([]) == [] and encode(["", "a"])[0] == b""
    byte_ids = harmonic.encoded([t for _, t in odd], BYTE_FILE)
    assert [np.frombuffer(b, dtype="<u4").tolist() for b in byte_ids] == library_ids(BYTE_FILE, odd)


@pytest.mark.parametrize("kind", ["words", "counts", "pieces"])
def test_only_different_pieces_are_looked_up(monkeypatch, kind):
    asked, plain = [], encoders.PieceCache.all
    monkeypatch.setattr(encoders.PieceCache, "all", lambda cache, pieces: asked.append(pieces) or plain(cache, pieces))
    for made in (encoders.word_encoder, encoders.word_counter, encoders.piece_encoder):
        made.cache_clear()
    library = Tokenizer.from_file(BYTE_FILE if kind == "pieces" else WORD_FILE)
    odd = "Word, word. (WORD) don't Don'T's \u1e96 H\u0331 \u0130\u017f stra\xdfe&&& \xc9COLE*** a1b22 x<|endoftext|>y <| |> \x1c\x85 12.5% \x0b\u5b57\u3000\u5b57 e\u0301"
    values = [odd * 3, "", " ", "\n" + odd.lower(), "again " * 500, "again," * 7, "end<|endoftext|>"]
    ids = [np.array(library.encode(v, add_special_tokens=False).ids, dtype="<u4") for v in values]
    if kind == "counts":
        assert encoders.word_counter(WORD_FILE)(values) == [len(x) for x in ids]
    else:
        found = encoders.word_encoder(WORD_FILE)(values) if kind == "words" else harmonic.encoded(values, BYTE_FILE)
        assert found == [x.tobytes() for x in ids]
    assert asked and all(len(pieces) == len(set(pieces)) for pieces in asked)


def test_a_worker_frees_its_pieces_for_the_next_operator():
    cache = encoders.PieceCache(lambda pieces: pieces, limit=2)
    for piece in (b"a", b"b", b"c"):
        cache.all([piece])
    assert cache.young and cache.old
    weak_labels.scores_of(weak_labels.Model({}, 0.0, (4,), {})).func(pd.Series(["text"]))
    assert not cache.young and not cache.old


def test_scans_of_whole_texts_read_few_rows_at_once(spark, docs, conf):
    conf(spark__sql__parquet__columnarReaderBatchSize="4096")
    line_rules.cleaned(docs)
    assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) <= 512


def test_sections_join_to_the_text():
    for text in (ROWS[-9][1] or "", "x" * 700_000, "word \n" * 100_000, ""):
        assert "".join(encoders.sections(text, 1000)) == text


def test_token_counts(spark, docs, none, tmp_path):
    ids = library_ids(WORD_FILE, ROWS)
    expected = bag((i, len((t or "").encode()), len(x), len(x) > 2048) for (i, t), x in zip(ROWS, ids))
    cache = str(tmp_path / "counts")
    assert bag(token_counts.token_counts(docs, cache, WORD_FILE).collect()) == expected
    stored = spark.read.parquet(cache).count()
    assert bag(token_counts.token_counts(docs, cache, WORD_FILE).collect()) == expected
    assert spark.read.parquet(cache).count() == stored  # nothing was missing
    piece = public_tokenizers.path("piece_bpe_32k.model")
    few = docs.where("doc_id < 10 or doc_id = 406")
    assert token_counts.token_counts(few, cache, piece).where("n_tokens is null").count() == 0
    assert spark.read.parquet(cache).select("version").distinct().count() == 2
    assert token_counts.token_counts(none, str(tmp_path / "none"), WORD_FILE).count() == 0
    again = docs.sparkSession.createDataFrame([(7, "the same row")] * 50, "doc_id long, text string").coalesce(1)
    assert token_counts.token_counts(again, str(tmp_path / "again"), WORD_FILE).count() == 50
    assert spark.read.parquet(str(tmp_path / "again")).count() == 1  # rows alike in id and text are encoded once


def test_token_frames(spark, docs, none, tmp_path):
    manifest = token_frames.write(docs, str(tmp_path / "frames"), WORD_FILE)
    got = token_frames.read(manifest).collect()
    counts = {}
    for (i, _), ids in zip(ROWS, library_ids(WORD_FILE, ROWS)):
        data = np.array([*ids, 1], dtype="<u4").tobytes()
        counts.setdefault(i, []).append((len(ids) + 1, zlib.crc32(data)))
    assert bag((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == bag((i, *x) for i, found in counts.items() for x in found)
    start = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == start
        start += r["n_tokens"]
    order = [(-1 if r["doc_id"] is None else r["doc_id"]) for r in sorted(got, key=lambda r: r["start"])]
    assert order == sorted(order)
    some = token_frames.read(manifest, {409, 100, 9999}).collect()
    assert sorted(r["doc_id"] for r in some) == [100, 409]
    empty = token_frames.write(none, str(tmp_path / "none"), WORD_FILE)
    assert token_frames.read(empty).count() == 0


def test_a_damaged_frame_is_noticed(tmp_path):
    import io

    out = io.BytesIO()
    about = token_frames.write_shard(out, [(7, b"\x01\x00\x00\x00" * 50), (None, b""), (9, b"\x02\x00\x00\x00")])
    assert (about["n_docs"], about["n_ids"], about["first_id"], about["last_id"]) == (3, 51, 7, 9)

    class Source(io.BytesIO):
        def size(self):
            return len(self.getvalue())

    good = list(token_frames.read_shard(Source(out.getvalue())))
    assert [(k, len(b)) for _, k, b in good] == [(7, 200), (None, 0), (9, 4)]
    # A table entry with another checksum: the frame itself is whole, the table says otherwise.
    data = bytearray(out.getvalue())
    data[-9 - 3 * 12 + 8] ^= 1
    with pytest.raises(ValueError):
        list(token_frames.read_shard(Source(bytes(data))))


def test_packing(spark, docs, none):
    rows = harmonic.pack(docs, BYTE_FILE, keep_ids=True).collect()
    expected = [np.array([*ids, 0], dtype="<u4").tobytes() for ids in library_ids(BYTE_FILE, ROWS)]
    held = {}
    for r in rows:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for found in held.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 1024
    full = {}
    for r in sorted(rows, key=lambda r: r["start"]):
        if r["doc_id"] not in (400, 101, 404):  # rows that repeat an id can't be told apart here
            full[r["doc_id"]] = full.get(r["doc_id"], b"") + bytes(r["ids"])
    assert full == {i: x for (i, _), x in zip(ROWS, expected) if i not in (400, 101, 404)}
    assert sum(r["length"] for r in rows) == sum(map(len, expected)) // 4
    assert sorted(held) == list(range(len(held)))
    assert harmonic.pack(none, BYTE_FILE).count() == 0


def test_classes_have_a_fixed_number_of_pieces(spark):
    rng = random.Random(12)
    rows = [(i, "a " * rng.choice([3, 20, 60, 100, 130, 300, 700, 1500])) for i in range(900)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    packed = harmonic.pack(frame, BYTE_FILE).collect()
    kinds = {}
    for r in packed:
        kinds.setdefault(r["sequence_id"], []).append(1024 // r["length"])
    mixed = [k for k in kinds.values() if len(set(k)) > 1]
    # A sequence takes k pieces of class k; the few that first-fit puts together hold the rests of several classes.
    alike = [k for k in kinds.values() if len(set(k)) == 1]
    short = [k for k in alike if len(k) != k[0]]
    assert len(mixed) + len(short) <= 8 and len(alike) > 200
    tokens = sum(r["length"] for r in packed)
    assert 1024 * len(kinds) < 1.12 * tokens  # little padding


def test_cuts_and_first_fit():
    assert harmonic.cuts(2048 + 700, 1024, (2, 4, 8)) == [1024, 1024, 512, 128, 60]
    assert harmonic.cuts(1, 1024, (2, 4, 8)) == [1]
    spots = harmonic.first_fit([(1, 900), (2, 100), (3, 100), (4, 24)], 1024)
    assert spots == {1: (0, 0), 2: (0, 900), 3: (1, 0), 4: (0, 1000)}
    assert base64.b64encode(encoders.packed([1])) == b"AQAAAA=="


def test_packing_numbers_the_pieces_of_many_small_files(spark, tmp_path):
    rows = [(i, f"w{i} " * (i % 40)) for i in range(90)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(30).write.option("parquet.block.size", 1).parquet(str(tmp_path / "docs"))
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))
    try:
        cut = harmonic.pieces(spark.read.parquet(str(tmp_path / "docs")), BYTE_FILE, 64, 0, (2,), False, "doc_id", "text").collect()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len({r["worker"] for r in cut}) <= spark.sparkContext.defaultParallelism  # 30 before
    places = [(r["worker"], r["kind"], r["place"]) for r in cut]
    assert len(places) == len(set(places)) and {r["doc_id"] for r in cut} == set(range(90))


def test_a_worker_that_changes_operators_drops_its_tokenizers():
    encoders.word_encoder(WORD_FILE)(["one two"])
    harmonic.encoded(["one two"], BYTE_FILE)
    assert list(encoders.tidy(lambda batches: iter([encoders.word_encoder.cache_info().currsize, *batches]))([7])) == [0, 7]
    assert encoders.piece_encoder.cache_info().currsize == 0
