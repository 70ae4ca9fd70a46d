"""SentencePiece encoding and decoding: batched numpy Viterbi over a given vocabulary.

The text is taken with a leading space, spaces become U+2581, and the best-scoring
segmentation into pieces is found (unigram Viterbi over the file's scores; of equal
scores, the longer last piece). Characters that no piece covers become byte pieces, and so
does a U+2581 of the text itself, so decoding gives the text back exactly.

No piece crosses from a letter to a following space mark (checked when the file is read),
so words are segmented on their own, each distinct one once a batch. Words of equal length
advance together: hashes of their substrings probe the sorted hashes of the pieces, and
vectorised maxima store backpointers. The vocabulary is a parameter, read by the driver
and broadcast (its size doesn't depend on the data).

Nulls: a null text is empty; an empty text has no ids. Equal rows get equal ids. An empty
table gives an empty result. Input columns travel in one struct.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelcat.llm.common import as_bytes, flat_ranges, list_array, packed, small_batches, table, whole

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
U = np.uint64
BASES = (U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F))
NEVER = -1e30
BATCH = 2 << 20
#: Score of a character given as bytes: below any piece, as in the original's unknown penalty.
BYTES_SCORE = -1e9 - 1e6


@dataclass(frozen=True)
class Vocabulary:
    keys: np.ndarray  # sorted hashes of the pieces
    checks: np.ndarray  # a second hash of each
    ids: np.ndarray
    scores: np.ndarray
    longest: int
    byte_ids: np.ndarray  # the piece of each byte
    contents: pa.Array  # of each id, the bytes it stands for


def _hashes(codes: np.ndarray, base: np.uint64) -> np.ndarray:
    """Hashes of equal-length rows of code points."""
    h = np.zeros(codes.shape[0], U)
    for k in range(codes.shape[1]):
        h = h * base + codes[:, k]
        h ^= h >> U(31)
    return h


def vocabulary(path: str = MODEL) -> Vocabulary:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    byte_ids, pieces, contents = np.full(256, -1, np.int64), [], []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(piece[1:-1], 16)] = i
            contents.append(bytes([int(piece[1:-1], 16)]))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            contents.append(b"")
        else:
            if SPACE in piece.lstrip(SPACE):
                raise ValueError(f"piece {i} goes over a space: {piece}")
            pieces.append((piece, i, sp.get_score(i)))
            contents.append(piece.replace(SPACE, " ").encode())
    if (byte_ids < 0).any():
        raise ValueError(f"{path} has no byte pieces, so it can't give every text back")
    keys, checks = np.zeros(len(pieces), U), np.zeros(len(pieces), U)
    longest = max(len(p[0]) for p in pieces)
    for n in range(1, longest + 1):
        at = [k for k, p in enumerate(pieces) if len(p[0]) == n]
        if at:
            codes = np.array([[ord(c) for c in pieces[k][0]] for k in at], U)
            keys[at], checks[at] = _hashes(codes, BASES[0]) + U(n), _hashes(codes, BASES[1])
    order = np.argsort(keys)
    return Vocabulary(keys[order], checks[order], np.array([p[1] for p in pieces])[order], np.array([p[2] for p in pieces])[order],
                      longest, byte_ids, pa.array(contents, pa.binary()))


def _probe(codes: np.ndarray, at: np.ndarray, n: int, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(score, id) of the substrings codes[a:a+n]; NEVER and -1 where no piece equals it."""
    windows = codes[at[:, None] + np.arange(n)]
    key = _hashes(windows, BASES[0]) + U(n)
    k = np.minimum(np.searchsorted(v.keys, key), len(v.keys) - 1)
    ok = v.keys[k] == key
    ok[ok] = v.checks[k[ok]] == _hashes(windows[ok], BASES[1])
    return np.where(ok, v.scores[k], NEVER), np.where(ok, v.ids[k], -1)


def segment(codes: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Viterbi of words of equal length, ``codes`` [words, length], all advancing together.

    Gives (piece ending at each place, its length) along the backpointers: [words, length]
    arrays with -1 where no piece of the best path ends. An id of -2 stands for bytes.
    """
    words, length = codes.shape
    flat = codes.reshape(-1)
    best = np.full((length + 1, words), NEVER)
    best[0] = 0
    back, piece = np.zeros((length + 1, words), np.int32), np.full((length + 1, words), -2, np.int32)
    row = np.arange(words) * length
    found = {}
    for n in range(1, min(v.longest, length) + 1):
        at = (row[:, None] + np.arange(length - n + 1)).reshape(-1)
        s, i = _probe(flat, at, n, v)
        found[n] = s.reshape(words, -1).T.copy(), i.reshape(words, -1).T.copy()
    for end in range(1, length + 1):
        best[end], back[end] = best[end - 1] + BYTES_SCORE, 1
        for n in range(1, min(v.longest, end) + 1):
            s, i = found[n]
            total = best[end - n] + s[end - n]
            better = (s[end - n] > NEVER) & (total >= best[end])
            best[end] = np.where(better, total, best[end])
            back[end] = np.where(better, n, back[end])
            piece[end] = np.where(better, i[end - n], piece[end])
    ends, which = np.full((words, length), -1, np.int64), np.zeros((words, length), np.int64)
    at, live = np.full(words, length), np.arange(words)
    while len(live):
        a = at[live]
        ends[live, a - 1], which[live, a - 1] = piece[a, live], back[a, live]
        at[live] = a - back[a, live]
        live = live[at[live] > 0]
    return ends, which


def _segment_long(codes: np.ndarray, v: Vocabulary) -> np.ndarray:
    """The same for one long word, its probes made a stretch at a time; gives (id or -2) at each end, -1 elsewhere."""
    length, reach, stretch = len(codes), v.longest, 1 << 14
    best, back, piece = [NEVER] * (length + 1), np.zeros(length + 1, np.int32), np.full(length + 1, -2, np.int32)
    best[0] = 0.0
    for a in range(0, length, stretch):
        b = min(length, a + stretch)
        ending: dict[int, list] = {}
        for n in range(1, reach + 1):
            ends = np.arange(max(a + 1, n), b + 1)
            if len(ends):
                s, i = _probe(codes, ends - n, n, v)
                for k in np.flatnonzero(i >= 0).tolist():
                    ending.setdefault(int(ends[k]), []).append((n, float(s[k]), int(i[k])))
        for end in range(a + 1, b + 1):
            top, n0, i0 = best[end - 1] + BYTES_SCORE, 1, -2
            for n, s, i in ending.get(end, ()):
                if best[end - n] + s >= top:
                    top, n0, i0 = best[end - n] + s, n, i
            best[end], back[end], piece[end] = top, n0, i0
    out, at = np.full(length, -1, np.int64), length
    while at > 0:
        out[at - 1] = piece[at]
        at -= back[at]
    return out


LONG = 64


#: Stands for a U+2581 of the text itself, which no piece may match.
LITERAL = U(0xFFFFFFFF)


def encode_words(words: list[str], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, ids): the ids of each word, spaces taken as U+2581."""
    by_length: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        by_length.setdefault(len(w), []).append(k)
    got: list[tuple[np.ndarray, np.ndarray]] = []  # (word, id) in order within each word
    for n, at in by_length.items():
        step = max(1, (1 << 16) // n)
        for k in range(0, len(at), step):
            some = np.array(at[k : k + step])
            codes = np.frombuffer("".join(words[x] for x in some.tolist()).encode("utf-32-le"), np.uint32).astype(U).reshape(len(some), n)
            codes = np.where(codes == U(ord(SPACE)), LITERAL, np.where(codes == U(32), U(ord(SPACE)), codes))
            if n <= LONG:
                ends, _ = segment(codes, v)
            else:
                ends = np.stack([_segment_long(c, v) for c in codes])
            w, place = np.nonzero(ends != -1)
            ids = ends[w, place]
            raw = ids == -2
            if raw.any():  # a character as its UTF-8 bytes
                meant = {int(LITERAL): SPACE, ord(SPACE): " "}
                utf8 = [(meant.get(c) or chr(c)).encode() for c in codes[w[raw], place[raw]].tolist()]
                reps = np.ones(len(ids), np.int64)
                reps[raw] = [len(u) for u in utf8]
                spread = np.repeat(ids, reps)
                spread[np.repeat(raw, reps)] = v.byte_ids[np.frombuffer(b"".join(utf8), np.uint8)]
                w, ids = np.repeat(w, reps), spread
            got.append((some[w], ids))
    if not got:
        return np.zeros(len(words) + 1, np.int64), np.zeros(0, np.int64)
    word, ids = np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])
    order = np.argsort(word, kind="stable")
    return np.concatenate(([0], np.cumsum(np.bincount(word, minlength=len(words))))), ids[order]


def _words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Each text, after a space, cut before every run of spaces and around line feeds: (offsets, flat words)."""
    some = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise("", texts, " "))
    off, raw = as_bytes(some)
    raw, off = raw[off[0] : off[-1]], off - off[0]
    start = np.zeros(len(raw), bool)
    start[off[:-1][np.diff(off) > 0]] = True
    start[1:] |= ((raw[1:] == 32) & (raw[:-1] != 32)) | (raw[1:] == 10) | (raw[:-1] == 10)
    at = np.flatnonzero(start)
    words = pa.Array.from_buffers(pa.string(), len(at), [None, pa.py_buffer(np.append(at, len(raw)).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(raw))])
    return np.searchsorted(at, off), words


def _texts(ids: np.ndarray, off: np.ndarray, v: Vocabulary) -> pa.Array:
    """What lists of ids stand for."""
    at, raw = as_bytes(v.contents.take(pa.array(ids)))
    cuts, data = at[off], raw.data
    return pa.array([bytes(data[a:b])[1:].decode("utf-8", "replace") for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())], pa.string())


def _encode(text: str, vocab, with_decoded: bool):
    def run(batches):
        v = vocab.value
        for batch in small_batches(batches, BATCH):
            off, words = _words(pc.fill_null(pc.struct_field(batch["row"], [text]), ""))
            coded = words.dictionary_encode()
            w_off, w_ids = encode_words(coded.dictionary.to_pylist(), v)
            k = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            sizes = np.diff(w_off)[k]
            ids = w_ids[flat_ranges(w_off[:-1][k], sizes)]
            ends = np.concatenate(([0], np.cumsum(sizes)))[off]
            columns = {"row": batch["row"], "ids": list_array(ids.astype(np.int32), ends, pa.int32())}
            if with_decoded:
                columns["decoded"] = _texts(ids, ends, v)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def _decode(column: str, vocab):
    def run(batches):
        v = vocab.value
        for batch in small_batches(batches, BATCH):
            off = batch[column].offsets.to_numpy().astype(np.int64)
            texts = _texts(batch[column].flatten().to_numpy(zero_copy_only=False), off - off[0], v)
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, "decoded"])

    return run


def encode(docs: DataFrame, text: str = "text", model: str = MODEL, with_decoded: bool = False) -> DataFrame:
    """(row, ids) for each document; ``with_decoded`` adds what the ids stand for, from the same pass."""
    df = packed(docs)
    vocab = docs.sparkSession.sparkContext.broadcast(vocabulary(model))
    out = f"row {df.schema['row'].dataType.simpleString()}, ids array<int>" + (", decoded string" if with_decoded else "")
    return df.mapInArrow(_encode(text, vocab, with_decoded), out)


def decode(df: DataFrame, column: str = "ids", model: str = MODEL) -> DataFrame:
    """``df`` with the text its ids stand for, ``decoded``."""
    vocab = df.sparkSession.sparkContext.broadcast(vocabulary(model))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(_decode(column, vocab), f"{kinds}, decoded string")


def op10_sentencepiece(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = encode(docs, with_decoded=True)
    return back.select("row.doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"),
                       (F.col("decoded") == whole(F.col("row.text"))).alias("exact"))
