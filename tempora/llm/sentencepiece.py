"""SentencePiece encoding and decoding by a batched numpy Viterbi.

A text gets a leading space, spaces become U+2581, and it is cut into words: a run of U+2581 with
what follows it, and every character without a piece of its own as a word by itself.  No piece of
the vocabulary crosses such a cut (checked when it is loaded), so the best path of a text is that of
its words.  The distinct words of a batch are taken by length: words of one length are a matrix, the
hashes of all substrings of one length come from prefix sums and probe the sorted hashes of the
pieces of that length, and one pass over the positions keeps, for all words at once, the best score
and the length of the last piece.  Of equal scores the longer last piece wins.  Long words (text of a language
without spaces) are cut once more, where no piece that occurs in them goes across.

The scores are those of the model file.  A file of merge ("BPE") kind orders its pieces by rank, and
the path of the largest sum of its scores is not the result of its merges; see the README.

Defined results: a null or empty text has no ids; an unknown character becomes the pieces of its
UTF-8 bytes, and so does U+2581 itself, so that decoding gives every text back; bytes that are no
UTF-8 survive as byte pieces; a null list of ids decodes to null.  Texts are encoded whole,
however long; an empty table gives no rows; further columns aren't looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tempora.llm.common import (BASE, binary_array, byte_slices, documents, inverse, list_array, powers,
                                prefix_hashes, utf8)

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = 0x2581
CELLS = 1 << 21  # substrings that one step of the Viterbi holds
LONG = 48  # characters above which a word is cut where no piece goes across, so that its parts advance together


class Vocabulary:
    """Pieces and scores of a model file with byte pieces, as arrays (about 2 MB for 32,000 pieces)."""

    def __init__(self, path: str = MODEL):
        import sentencepiece as sp

        model = sp.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.byte_id = np.full(256, -1, np.int32)
        surface, by_length = [b""] * n, {}
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[1:-1], 16)
                self.byte_id[value], surface[i] = i, bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                body = piece.lstrip("▁")
                if "▁" in body:
                    raise ValueError(f"piece {piece!r} goes across a space")
                surface[i] = piece.replace("▁", " ").encode()
                by_length.setdefault(len(piece), []).append((piece, model.get_score(i), i))
        if (self.byte_id < 0).any():
            raise ValueError("the model has no byte pieces")
        chars = {p for p, _, _ in by_length.get(1, [])} | {"▁"}
        known = np.zeros(0x110000, bool)
        known[[ord(c) for c in chars]] = True
        self.known = np.packbits(known)
        self.tables = {}
        for length, pieces in sorted(by_length.items()):
            if any(set(p) - chars for p, _, _ in pieces):
                raise ValueError("a piece holds a character that is no piece")
            cp = np.frombuffer("".join(p for p, _, _ in pieces).encode("utf-32-le"), np.uint32)
            h = (cp.reshape(-1, length).astype(np.uint64) * powers(BASE, length)).sum(
                axis=1, dtype=np.uint64)
            order = np.argsort(h)
            self.tables[length] = (h[order], np.array([s for _, s, _ in pieces], np.float64)[order],
                                   np.array([i for _, _, i in pieces], np.int32)[order])
        self.bytes = np.frombuffer(b"".join(surface), np.uint8)
        self.at = np.concatenate([[0], np.cumsum([len(s) for s in surface])]).astype(np.int64)


def viterbi(cp: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words on end, number of ids of each) for words as rows of code points."""
    n, length = cp.shape
    weighted = cp.astype(np.uint64) * powers(BASE, length)
    prefix = np.zeros((n, length + 1), np.uint64)
    np.cumsum(weighted, axis=1, out=prefix[:, 1:])
    back = powers(inverse(BASE), length + 1)
    score, ids = {}, {}
    for k, (keys, scores, numbers) in vocabulary.tables.items():
        if k > length:
            break
        h = (prefix[:, k:] - prefix[:, :-k]) * back[:length - k + 1]
        at = np.searchsorted(keys, h)
        at[at == len(keys)] = 0
        hit = keys[at] == h
        if hit.any() or k == 1:
            score[k] = np.where(hit, scores[at], -np.inf)
            ids[k] = np.where(hit, numbers[at], -1)
    lengths = sorted(score, reverse=True)
    best = np.full((n, length + 1), -np.inf)
    best[:, 0] = 0
    taken = np.zeros((n, length + 1), np.int32)
    for end in range(1, length + 1):
        fit = [k for k in lengths if k <= end]
        options = np.stack([best[:, end - k] + score[k][:, end - k] for k in fit])
        which = options.argmax(axis=0)
        best[:, end] = options[which, np.arange(n)]
        taken[:, end] = np.array(fit, np.int32)[which]
    found = np.full((n, length), -1, np.int32)  # the id of the piece that starts at each character
    end = np.full(n, length)
    row = np.arange(n)
    while len(row):
        k = taken[row, end]
        start = end - k
        for size in np.unique(k).tolist():
            of = k == size
            found[row[of], start[of]] = ids[size][row[of], start[of]]
        row, end = row[start > 0], start[start > 0]
    used = found >= 0
    return found[used], used.sum(axis=1)


def _spans(length: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Indexes starts[i] .. starts[i] + length[i] - 1, on end."""
    first = np.concatenate([[0], np.cumsum(length)[:-1]]) if len(length) else np.empty(0, np.int64)
    return np.repeat(starts - first, length) + np.arange(length.sum())


def uncrossed(prefix: np.ndarray, first: np.ndarray, length: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Places within the words first[i] .. first[i] + length[i] - 1 that no piece found there goes across: every path
    passes them, so the words can be cut there."""
    out = []
    back = powers(inverse(BASE), len(prefix))
    for a, n in zip(first.tolist(), length.tolist()):
        crossed = np.zeros(n + 1, np.int32)
        for k, (keys, _, _) in vocabulary.tables.items():
            if 1 < k <= n:
                h = (prefix[a + k:a + n + 1] - prefix[a:a + n + 1 - k]) * back[a:a + n + 1 - k]
                at = np.searchsorted(keys, h)
                at[at == len(keys)] = 0
                hit = np.flatnonzero(keys[at] == h)  # from place hit on: goes across hit + 1 .. hit + k - 1
                np.add.at(crossed, hit + 1, 1)
                np.add.at(crossed, hit + k, -1)
        free = np.flatnonzero(np.cumsum(crossed[:-1]) == 0)
        out.append(a + free[free > 0])
    return np.concatenate(out)


def encode_texts(texts: pa.Array, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(ids on end, number of ids of each text)."""
    data, offsets = utf8(texts)
    if not len(data):
        return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
    try:
        text = bytes(data).decode("utf-8")
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    except UnicodeDecodeError:
        parts = [bytes(data[a:b]).decode("utf-8", "surrogateescape")
                 for a, b in zip(offsets, offsets[1:])]
        text = "".join(parts)
        chars = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    full = np.flatnonzero(np.diff(chars))
    # a space before each text that isn't empty
    cp = np.insert(raw, chars[:-1][full], 0x20)
    head = chars[:-1][full] + np.arange(len(full))
    blank = cp == 0x20
    # U+2581 of the text itself is unknown: only a space may be written with it
    known = blank | (np.unpackbits(vocabulary.known, count=0x110000).view(bool)[cp] & (cp != SPACE))
    cp[blank] = SPACE
    start = np.zeros(len(cp), bool)
    start[head] = True
    start[1:] |= (blank[1:] & ~blank[:-1]) | ~known[1:] | ~known[:-1]
    first = np.flatnonzero(start)
    length = np.diff(np.append(first, len(cp)))
    prefix = prefix_hashes(np.where(known, cp, cp + np.uint32(0x110000)).astype(np.uint64))
    if length.max() > LONG:
        start[uncrossed(prefix, first[length > LONG], length[length > LONG], vocabulary)] = True
        first = np.flatnonzero(start)
        length = np.diff(np.append(first, len(cp)))
    word = (prefix[first + length] - prefix[first]) * powers(inverse(BASE), len(prefix))[first]
    word = word + length.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
    _, example, of = np.unique(word, return_index=True, return_inverse=True)
    size, strange = length[example], ~known[first[example]]
    count = np.zeros(len(example), np.int64)
    pieces: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if strange.any():
        odd = np.flatnonzero(strange)
        coded = [bytes([c & 0xFF]) if 0xDC80 <= c <= 0xDCFF else chr(c).encode("utf-8", "surrogatepass")
                 for c in cp[first[example[odd]]].tolist()]
        pieces.append((odd, vocabulary.byte_id[np.frombuffer(b"".join(coded), np.uint8)],
                       np.array([len(c) for c in coded])))
    for k in np.unique(size[~strange]).tolist():
        same = np.flatnonzero((size == k) & ~strange)
        step = max(1, CELLS // k)
        for a in range(0, len(same), step):
            part = same[a:a + step]
            got = viterbi(cp[first[example[part]][:, None] + np.arange(k)], vocabulary)
            pieces.append((part, *got))
    for part, _, n in pieces:
        count[part] = n
    at = np.concatenate([[0], np.cumsum(count)])
    ids = np.empty(at[-1], np.int32)
    for part, values, n in pieces:
        ids[_spans(n, at[part])] = values
    tokens = ids[_spans(count[of], at[of])]
    text_of = np.searchsorted(head, first, "right") - 1
    per = np.zeros(len(texts), np.int64)
    np.add.at(per, full[text_of], count[of])
    return tokens, per


def decode_ids(ids: np.ndarray, per: np.ndarray, vocabulary: Vocabulary) -> pa.Array:
    """The texts of lists of ids, as binaries."""
    size = np.diff(vocabulary.at)[ids]
    data = vocabulary.bytes[_spans(size, vocabulary.at[ids])]
    bytes_to = np.concatenate([[0], np.cumsum(size)])
    ends = np.concatenate([[0], np.cumsum(per)])
    start, end = bytes_to[ends[:-1]], bytes_to[ends[1:]]
    lead = (end > start) & (np.append(data, 0)[start] == 0x20)  # the space that encoding put there
    return binary_array(data, start + lead, end)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           vocabulary: Vocabulary | None = None, check: bool = False) -> DataFrame:
    """``<id_col>, ids, n_tokens`` per row; with ``check`` also ``round_trip``: decoding gives the
    text back."""
    vocabulary = vocabulary or Vocabulary()
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text", 1 << 20):
            ids, per = encode_texts(batch.column("text"), vocabulary)
            out = [batch.column("id"), list_array(pa.array(ids, pa.int32()), per),
                   pa.array(per, pa.int64())]
            if check:
                back = decode_ids(ids, per, vocabulary)
                text = pc.fill_null(batch.column("text"), "").cast(pa.binary())
                out.append(pc.equal(back, text))
            yield pa.RecordBatch.from_arrays(out, names=names)

    schema = T.StructType([T.StructField(id_col, rows.schema["id"].dataType),
                           T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("n_tokens", T.LongType())]
                          + [T.StructField("round_trip", T.BooleanType())] * check)
    names = schema.names
    return rows.mapInArrow(run, schema)


def decode(tokens: DataFrame, id_col: str = "doc_id", ids_col: str = "ids",
           vocabulary: Vocabulary | None = None) -> DataFrame:
    """``<id_col>, text`` for lists of ids."""
    vocabulary = vocabulary or Vocabulary()
    rows = tokens.select(tokens[id_col].alias("id"), tokens[ids_col].alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            per = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            text = decode_ids(ids, per.astype(np.int64), vocabulary).cast(pa.string())
            text = pc.if_else(pc.is_null(lists), pa.scalar(None, pa.string()), text)
            yield pa.RecordBatch.from_arrays([batch.column("id"), text], names=[id_col, "text"])

    return rows.mapInArrow(run, T.StructType([T.StructField(id_col, rows.schema["id"].dataType),
                                              T.StructField("text", T.StringType())]))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(documents(spark, sf_dir), check=True)
