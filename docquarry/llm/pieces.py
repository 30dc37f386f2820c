"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

The pieces and their log scores are read from a model file, whose path is a parameter.
A text is normalised as the model says (marker for white space, dummy prefix), and the
segmentation with the largest sum of scores is found; characters that no piece covers
become byte pieces. If no piece holds a marker after another character, the best
segmentation of a text is that of its words one after the other, so each distinct word
of a batch is segmented once, all words of one length together, and remembered in a
bounded table. Scores add up in double precision; of equal paths the one whose last
piece is longer wins.

Defined results: null and empty texts have no pieces and decode to the empty text; a text
that holds the marker U+2581 itself decodes to one with spaces in its place;
bytes that are no valid UTF-8 decode to U+FFFD each; control pieces decode to nothing
and ids outside the vocabulary raise an error; further columns are carried along, those
named like a result column are replaced; the other normalisers than identity and NFKC
are refused.
"""

from __future__ import annotations

import re
import struct
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Fixed values of the model format.
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_PENALTY = 10.0
UNKNOWN_SURFACE = " ⁇ "

LONG = 64  # bytes; longer words are segmented one by one
GROUP = 20_000
BLOCK_BYTES = 1 << 20  # of text that is split into words at a time
REMEMBERED_BYTES = 24 << 20  # of words, their ids and what the table itself takes


# ---------------------------------------------------------------- model file


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a protocol buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        wire = key & 7
        if wire == 0:
            yield key >> 3, varint()
        elif wire == 2:
            size = varint()
            yield key >> 3, data[at : at + size]
            at += size
        else:
            size = {1: 8, 5: 4}[wire]
            yield key >> 3, data[at : at + size]
            at += size


class DoubleArray:
    """A trie of byte strings: child = base[node] + byte, if check[child] == node."""

    def __init__(self, keys: list[tuple[bytes, int]]):
        children: list[dict[int, int]] = [{}]
        values = [-1]
        for key, value in keys:
            node = 0
            for byte in key:
                after = children[node].get(byte)
                if after is None:
                    after = children[node][byte] = len(children)
                    children.append({})
                    values.append(-1)
                node = after
            values[node] = value
        size = 2 * len(children) + 1024
        self.base = np.zeros(size, np.int32)
        self.check = np.full(size, -1, np.int32)
        self.value = np.full(size, -1, np.int32)
        free = np.ones(size, bool)
        free[0] = False
        # nodes with one child fill the first gaps, others go on where the last one fitted
        first, later, queue = 1, 1, [(0, 0)]
        for node, place in queue:
            labels = np.array(sorted(children[node]), np.int64)
            if not len(labels):
                continue
            while not free[first]:
                first += 1
            start, span = first if len(labels) == 1 else max(first, later), 64
            while True:
                if start + span + 512 > size:
                    grown = size // 2 + span + 512
                    self.base = np.r_[self.base, np.zeros(grown, np.int32)]
                    self.check = np.r_[self.check, np.full(grown, -1, np.int32)]
                    self.value = np.r_[self.value, np.full(grown, -1, np.int32)]
                    free = np.r_[free, np.ones(grown, bool)]
                    size += grown
                bases = start + np.flatnonzero(free[start : start + span]) - labels[0]
                bases = bases[bases >= 0]
                fits = free[bases[:, None] + labels].all(axis=1)
                if fits.any():
                    base = int(bases[fits.argmax()])
                    break
                start, span = start + span, min(4 * span, 4096)
            self.base[place] = base
            if len(labels) > 1:
                later = base + int(labels[0])
            for label in labels.tolist():
                child, after = base + label, children[node][label]
                free[child] = False
                self.check[child] = place
                self.value[child] = values[after]
                queue.append((after, child))
        used = int(np.flatnonzero(~free).max()) + 257
        if used > size:
            self.check = np.r_[self.check, np.full(used - size, -1, np.int32)]
        self.base, self.check, self.value = self.base[:used], self.check[:used], self.value[:used]
        short = used - len(self.base)
        if short > 0:
            self.base = np.r_[self.base, np.zeros(short, np.int32)]
            self.value = np.r_[self.value, np.full(short, -1, np.int32)]


@dataclass
class Model:
    pieces: list[str]
    scores: np.ndarray
    kinds: list[int]
    dummy_prefix: bool
    trim: bool
    nfkc: bool

    def __post_init__(self):
        in_trie = (NORMAL, USER_DEFINED, UNUSED)
        keys = [(p.encode(), i) for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k in in_trie and p]
        self.trie = DoubleArray(keys)
        normal = [s for s, k in zip(self.scores, self.kinds) if k in in_trie]
        self.unknown_score = (min(normal) if normal else 0.0) - UNKNOWN_PENALTY
        self.unknown = self.kinds.index(UNKNOWN) if UNKNOWN in self.kinds else 0
        self.byte_ids: list[int] | None = None
        if self.kinds.count(BYTE) == 256:
            ids = {int(p[3:-1], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == BYTE}
            self.byte_ids = [ids[b] for b in range(256)]
        words = [p for p, k in zip(self.pieces, self.kinds) if k in in_trie]
        self.by_word = not any(re.search(f"[^{MARK}]{MARK}", p) for p in words)
        alone = not any("\n" in p and len(p) > 1 for p in words)
        line = "\n|" if alone else ""
        stop = "\n" if alone else ""
        self.splitter = re.compile(f"{line}{MARK}*[^{MARK}{stop}]+|{MARK}+")
        self.surface = [
            bytes([int(p[3:-1], 16)]) if k == BYTE
            else b"" if k == CONTROL
            else UNKNOWN_SURFACE.encode() if k == UNKNOWN
            else p.replace(MARK, " ").encode()
            for p, k in zip(self.pieces, self.kinds)
        ]

    # ------------------------------------------------------------ encoding

    def normalise(self, text: str) -> str:
        """The text that is segmented, markers in place of blanks."""
        if self.nfkc:
            text = unicodedata.normalize("NFKC", text)
        if self.trim:
            text = re.sub(" +", " ", text).strip(" ")
        if text and self.dummy_prefix:
            text = " " + text
        return text.replace(" ", MARK)

    def words(self, text: str) -> list[str]:
        """Parts of a normalised text whose segmentations do not depend on each other."""
        return self.splitter.findall(text) if self.by_word else [text] if text else []

    def _ids(self, raw: bytes, cuts: list[tuple[int, int, int]]) -> np.ndarray:
        ids: list[int] = []
        for start, end, piece in cuts:
            if piece >= 0:
                ids.append(piece)
            elif self.byte_ids:
                ids += [self.byte_ids[b] for b in raw[start:end]]
            else:
                ids.append(self.unknown)
        return np.array(ids, np.int32)

    def segment(self, raw: bytes) -> np.ndarray:
        """Ids of the best segmentation of one word."""
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        size = len(raw)
        best = [-np.inf] * (size + 1)
        back, with_piece = [0] * (size + 1), [-1] * (size + 1)
        best[0] = 0.0
        for start in range(size):
            here = best[start]
            if here == -np.inf:
                continue
            lead = raw[start]
            width = 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            node, single = 0, False
            for end in range(start, size):
                child = int(base[node]) + raw[end]
                if check[child] != node:
                    break
                node, piece = child, int(value[child])
                if piece >= 0:
                    single = single or end + 1 - start == width
                    score = here + self.scores[piece]
                    if score > best[end + 1]:
                        best[end + 1], back[end + 1], with_piece[end + 1] = score, start, piece
            if not single and here + self.unknown_score > best[start + width]:
                end = start + width
                best[end], back[end], with_piece[end] = here + self.unknown_score, start, -1
        cuts, end = [], size
        while end:
            cuts.append((back[end], end, with_piece[end]))
            end = back[end]
        return self._ids(raw, cuts[::-1])

    def segment_many(self, words: list[str]) -> dict[str, bytes]:
        """Ids, as bytes, of many words; those of one length are walked together."""
        out: dict[str, bytes] = {}
        by_size: dict[int, list[tuple[str, bytes]]] = {}
        for word in words:
            raw = word.encode()
            if len(raw) > LONG:
                out[word] = self.segment(raw).tobytes()
            else:
                by_size.setdefault(len(raw), []).append((word, raw))
        for size, group in by_size.items():
            for start in range(0, len(group), GROUP):
                part = group[start : start + GROUP]
                ids = self._walk([raw for _, raw in part], size)
                out.update((word, i) for (word, _), i in zip(part, ids))
        return out

    def _walk(self, raws: list[bytes], size: int) -> list[bytes]:
        """Ids, as bytes, of words of one length."""
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        text = np.frombuffer(b"".join(raws), np.uint8).reshape(len(raws), size)
        width = np.select([text < 0xC0, text < 0xE0, text < 0xF0], [1, 2, 3], 4)
        best = np.full((len(raws), size + 1), -np.inf)
        best[:, 0] = 0.0
        back = np.zeros(best.shape, np.int16)
        with_piece = np.full(best.shape, -1, np.int32)

        def update(rows, end, score, start, piece):
            better = score > best[rows, end]
            rows = rows[better]
            end = end[better] if isinstance(end, np.ndarray) else end
            best[rows, end] = score[better]
            back[rows, end] = start
            with_piece[rows, end] = piece[better] if isinstance(piece, np.ndarray) else piece

        for start in range(size):
            rows = np.flatnonzero(best[:, start] > -np.inf)
            if not len(rows):
                continue
            here, wide = best[rows, start], width[rows, start]
            single = np.zeros(len(rows), bool)
            place, node = np.arange(len(rows)), np.zeros(len(rows), np.int64)
            for end in range(start, size):
                child = base[node] + text[rows[place], end]
                going = check[child] == node
                place, node = place[going], child[going]
                if not len(place):
                    break
                piece = value[node]
                is_piece = piece >= 0
                at, found = place[is_piece], piece[is_piece]
                single[at] |= wide[at] == end + 1 - start
                update(rows[at], end + 1, here[at] + self.scores[found], start, found)
            bare = ~single
            update(rows[bare], start + wide[bare], here[bare] + self.unknown_score, start, -1)
        # all paths back at once, last piece first
        rows, at, steps = np.arange(len(raws)), np.full(len(raws), size), []
        while at.any():
            steps.append(np.where(at > 0, with_piece[rows, at], -2))
            at = np.where(at > 0, back[rows, at], 0)
        paths = np.stack(steps[::-1], axis=1)
        taken = paths >= 0
        ends = np.cumsum(taken.sum(axis=1)) * 4
        ids = paths[taken].astype(np.int32).tobytes()
        out = [ids[start:end] for start, end in zip([0, *ends[:-1].tolist()], ends.tolist())]
        for row in np.flatnonzero((paths == -1).any(axis=1)).tolist():  # with unknown characters
            out[row] = self.segment(raws[row]).tobytes()
        return out

    def encode(self, text: str | None) -> list[int]:
        words = self.words(self.normalise(text or ""))
        return [int(i) for word in words for i in self.segment(word.encode())]

    # ------------------------------------------------------------ decoding

    def decode(self, ids) -> str:
        ids = np.asarray(ids, np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.surface)):
            raise ValueError("an id lies outside the vocabulary")
        raw = b"".join(map(self.surface.__getitem__, ids.tolist()))
        if len(ids) and self.dummy_prefix and self.pieces[ids[0]].startswith(MARK):
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return _decode_loosely(raw)


def _decode_loosely(raw: bytes) -> str:
    """Valid UTF-8 as it is, U+FFFD for every other byte."""
    out, at = [], 0
    while at < len(raw):
        try:
            out.append(raw[at:].decode())
            break
        except UnicodeDecodeError as error:
            out.append(raw[at : at + error.start].decode() + "�")
            at += error.start + 1
    return "".join(out)


@lru_cache(maxsize=4)
def load(path: str) -> Model:
    """Read a model file, once per path."""
    with open(path, "rb") as file:
        return parse(file.read())


def parse(data: bytes) -> Model:
    """The model in a file's bytes."""
    pieces, scores, kinds = [], [], []
    dummy_prefix, trim, escape, name = True, True, True, ""
    for number, value in _fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for field, content in _fields(value):
                if field == 1:
                    piece = content.decode()
                elif field == 2:
                    score = struct.unpack("<f", content)[0]
                elif field == 3:
                    kind = content
            pieces.append(piece)
            scores.append(score)
            kinds.append(kind)
        elif number == 3:
            for field, content in _fields(value):
                if field == 1:
                    name = content.decode()
                elif field == 3:
                    dummy_prefix = bool(content)
                elif field == 4:
                    trim = bool(content)
                elif field == 5:
                    escape = bool(content)
    if name not in ("", "identity", "nfkc", "nmt_nfkc") or not escape:
        raise ValueError(f"normaliser {name!r} is not supported")
    return Model(pieces, np.array(scores, np.float64), kinds, dummy_prefix, trim, "nfkc" in name)


# ---------------------------------------------------------------- Spark


class Coder:
    """Encodes texts; the ids of words are remembered, up to a number of bytes."""

    def __init__(self, model: Model):
        self.model, self.known, self.held = model, {}, 0

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where those of each start; one more at the end."""
        split = [self.model.words(self.model.normalise(text or "")) for text in texts]
        if self.held > REMEMBERED_BYTES:
            self.known, self.held = {}, 0
        new = {word for words in split for word in words if word not in self.known}
        found = self.model.segment_many(list(new))
        self.held += sum(200 + len(word) + len(ids) for word, ids in found.items())
        self.known |= found
        coded = [b"".join(map(self.known.__getitem__, words)) for words in split]
        ends = np.cumsum([0, *(len(c) // 4 for c in coded)]).astype(np.int32)
        return np.frombuffer(b"".join(coded), np.int32), ends


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Rows of a batch with their texts, about BLOCK_BYTES at a time."""
    column = batch.column(batch.schema.get_field_index("text"))
    sizes = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(column), 0).to_numpy(zero_copy_only=False))
    first = 0
    while first < batch.num_rows:
        before = int(sizes[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(sizes, before + BLOCK_BYTES, side="right")))
        part = batch.slice(first, last - first)
        yield part, column.slice(first, last - first).to_pylist()
        first = last


def _coded(docs: DataFrame, kept: list[str], added: T.StructType, code) -> DataFrame:
    """The columns ``kept`` of ``docs``, and those that ``code`` makes of each block's texts."""
    fields = [docs.schema[name] for name in kept]
    names = [*kept, *added.fieldNames()]

    def run(batches):
        work = code()
        for whole in batches:
            for batch, texts in _blocks(whole):
                held = [batch.column(batch.schema.get_field_index(name)) for name in kept]
                yield pa.RecordBatch.from_arrays([*held, *work(texts)], names=names)

    return docs.mapInArrow(run, T.StructType(fields + added.fields))


def _ids(model: Model, back: bool):
    """Makes ids and their number of texts, and the texts decoded from them."""
    coder = Coder(model)

    def work(texts):
        flat, ends = coder.encode(texts)
        ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
        columns = [ids, pa.array(np.diff(ends).astype(np.int64))]
        if back:
            bounds = ends.tolist()
            decoded = [model.decode(flat[start:end]) for start, end in zip(bounds, bounds[1:])]
            columns.append(pa.array(decoded, pa.string()))
        return columns

    return work


def encode(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ids array<int> and n_pieces added; only the text is looked at."""
    added = T.StructType.fromDDL("ids array<int>, n_pieces long")
    docs = docs.drop(*added.fieldNames())
    return _coded(docs, docs.columns, added, lambda: _ids(model, back=False))


def recode(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ids, n_pieces and decoded, the text that the ids give back, in place
    of the text: encoding and decoding in one pass."""
    added = T.StructType.fromDDL("ids array<int>, n_pieces long, decoded string")
    docs = docs.drop(*added.fieldNames())
    kept = [name for name in docs.columns if name != "text"]
    return _coded(docs, kept, added, lambda: _ids(model, back=True))


def decode(coded: DataFrame, model: Model) -> DataFrame:
    """``coded`` (with ids array<int>) with the decoded text added; null ids decode to
    the empty text."""
    coded = coded.drop("decoded")

    def run(batches):
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("ids"))
            flat, ends = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
            known = ids.is_valid().to_pylist()
            texts = [
                model.decode(flat[start:end] if valid else ())
                for start, end, valid in zip(ends.tolist(), ends[1:].tolist(), known)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    return coded.mapInArrow(run, T.StructType(coded.schema.fields + [T.StructField("decoded", T.StringType())]))
