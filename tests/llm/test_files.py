"""WARC archives and SentencePiece: round trips and the libraries' own results."""

import hashlib
import os
import random

import pyarrow as pa
import pytest

from conftest import SMALL, tuples
from docquarry.llm import pieces, warc
from docquarry.llm.queries import PIECES, coded

PAGES = "page_id long, url string, html string, digest string, first long, payload int"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1, 1) for i, u, h in rows], PAGES)


def read_back(spark, table):
    manifest, folder = warc.archive(spark, table)
    return manifest, folder, warc.read_archives(warc.open_archives(spark, manifest, folder))


def test_archives_round_trip(spark):
    long = "<p>é</p>" * 100_000
    rows = [
        (5, "http://a/ü", "same page " * 20), (3, "http://b\r\nX: y", "same page " * 20), (9, None, "same page " * 20),
        (3, "again", "same page " * 20), (1, "short", "tiny"), (2, "short", "tiny"), (4, "", None), (6, "", ""),
        (None, "none", "same page " * 20), (7, "long", long), (8, "long", long), (None, None, None),
    ]
    manifest, folder, records = read_back(spark, pages(spark, rows))
    got = {(r.page_id, r.url): r for r in records.collect()}
    assert sum(r.records for r in manifest.collect()) == len(rows) == records.count()
    first, page = "http://b%0D%0AX: y", ("same page " * 20).encode()
    for key in ((3, first), (3, "again")):
        assert got[key].record_type == "response" and bytes(got[key].payload) == page
    for key in ((5, "http://a/ü"), (9, None), (None, "none")):
        assert (got[key].record_type, got[key].refers_to, got[key].payload) == ("revisit", 3, None)
        assert (got[key].payload_bytes, got[key].payload_digest) == (200, hashlib.sha256(page).hexdigest())
    assert {got[i, "short"].record_type for i in (1, 2)} == {"response"}
    assert got[8, "long"].refers_to == 7 and got[7, "long"].payload_bytes == len(long.encode())
    assert got[4, ""].payload_bytes == got[6, ""].payload_bytes == got[None, None].payload_bytes == 0
    # a file that no committed task wrote is not read
    path = folder.removeprefix("file://")
    with open(os.path.join(path, "left-over.warc.zst"), "wb") as file:
        file.write(b"cut off")
    again = warc.read_archives(warc.open_archives(spark, manifest, folder))
    assert again.count() == len(rows)


def test_no_pages(spark):
    assert read_back(spark, pages(spark, []))[2].isEmpty()


def test_broken_archives_are_refused(spark):
    import zstandard

    raw = warc.record_bytes(1, "u", b"payload", hashlib.sha256(b"payload").hexdigest(), None, False)
    pack = zstandard.ZstdCompressor(write_checksum=True).compress
    whole = warc.dictionary_frame(b"") + pack(raw) * 2
    assert len(list(warc.read_archive(whole, "a"))) == 2
    broken = [
        whole[:-3],
        whole[:20],
        pack(raw.replace(b"WARC/1.1", b"WARC/0.9")),
        pack(raw.replace(b"payload\r\n", b"pAyload\r\n")),
        pack(raw[:-4]),
        pack(raw + b"more"),
        pack(raw.replace(b"WARC-Record-ID", b"WARC-Record")),
        b"plain text",
    ]
    for content in broken:
        with pytest.raises(warc.ArchiveError):
            list(warc.read_archive(content, "a"))


# --- pieces -----------------------------------------------------------------


def unigram_model():
    """The model file with finite scores, and the library's unigram segmenter on it."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(PIECES, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = 1
    for piece in proto.pieces:
        piece.score = max(piece.score, -40_000)
    data = proto.SerializeToString()
    return pieces.parse(data), sentencepiece.SentencePieceProcessor(model_proto=data)


def test_pieces_equal_the_library(spark):
    model, library = unigram_model()
    lines = [
        line[:200]
        for row in spark.read.parquet(f"{SMALL}/documents.parquet").collect()
        for line in (row.text or "").split("\n")[:4]
    ]
    lines += ["", " ", "  two  blanks ", "▁mark", "naïve café", "数学", "\t tab"]
    for line in lines:
        ids = model.encode(line)
        assert ids == library.encode(line)
        assert model.decode(ids) == library.decode(ids) == line.replace("▁", " ")
    words = list({word for line in lines for word in model.words(model.normalise(line))})
    assert model.segment_many(words) == {w: model.segment(w.encode()).tobytes() for w in words}


def best(model, text):
    """Brute force: the largest sum of scores over all segmentations."""
    scores = {p: s for p, s, k in zip(model.pieces, model.scores, model.kinds) if k in (1, 4, 5)}
    sums = [0.0]
    for end in range(1, len(text) + 1):
        parts = [sums[i] + scores[text[i:end]] for i in range(end) if text[i:end] in scores]
        parts += [sums[end - 1] + model.unknown_score] * (text[end - 1] not in scores)
        sums.append(max(parts))
    return sums[-1]


def test_best_score_and_byte_fallback(spark):
    model = pieces.load(PIECES)
    rng = random.Random(3)
    for _ in range(50):
        text = "".join(rng.choices("theing▁ or\n€é", k=rng.randrange(1, 14)))
        norm, score = model.normalise(text), 0.0
        cuts, at = model.encode(text), 0
        unknown = 0
        while at < len(cuts):
            if model.kinds[cuts[at]] == pieces.BYTE:
                size = next(n for n in (1, 2, 3, 4) if _is_character(model, cuts[at : at + n]))
                unknown, at = unknown + 1, at + size
            else:
                score, at = score + model.scores[cuts[at]], at + 1
        assert score + unknown * model.unknown_score == pytest.approx(best(model, norm))
    assert model.decode(model.encode("a\U0001f9ffb\x00")) == "a\U0001f9ffb\x00"
    assert model.decode([model.byte_ids[0xFF], model.byte_ids[0x41]]) == "�A"
    with pytest.raises(ValueError):
        model.decode([10**6])


def _is_character(model, ids):
    try:
        return len(bytes(int(model.pieces[i][3:-1], 16) for i in ids).decode()) == 1
    except UnicodeDecodeError:
        return False


def test_coding_in_spark(spark):
    rows = [(1, None), (2, ""), (3, "x" * 5000), (4, " two  words\n"), (4, " two  words\n"), (None, "é▁")]
    table = spark.createDataFrame([(i, t, [1], 5, "d") for i, t in rows], "doc_id long, text string, ids array<int>, n_pieces int, decoded string")
    got = coded(table)
    assert tuples(got.filter("NOT round_trip"), "doc_id") == [(None,)]  # a marker in the text decodes to a blank
    assert {r.doc_id: r.n_pieces for r in got.collect() if r.doc_id in (1, 2)} == {1: 0, 2: 0}
    assert coded(table.limit(0)).isEmpty()
    known = pieces.load(PIECES)
    apart = pieces.decode(pieces.encode(table, known), known)
    assert tuples(apart, "doc_id", "ids", "decoded") == tuples(pieces.recode(table, known), "doc_id", "ids", "decoded")
    model = pieces.load(PIECES)
    nulls = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert tuples(pieces.decode(nulls, model), "decoded") == [("",), ("",)]


def test_coding_in_small_blocks(monkeypatch):
    model = pieces.load(PIECES)
    texts = [None, "", "the words of a text", "x" * 300, "é▁ the", "the words"] * 5
    whole = pieces.Coder(model).encode(texts)
    monkeypatch.setattr(pieces, "BLOCK_BYTES", 20)
    monkeypatch.setattr(pieces, "REMEMBERED_BYTES", 500)
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    coder, flat, seen = pieces.Coder(model), [], []
    for part, own in pieces._blocks(batch):
        assert part.num_rows == len(own) and (len(own) == 1 or sum(len((t or "").encode()) for t in own) <= 20)
        seen += own
        flat += coder.encode(own)[0].tolist()
        assert coder.held < 500 + 20 * 300
    assert seen == texts and flat == whole[0].tolist()
