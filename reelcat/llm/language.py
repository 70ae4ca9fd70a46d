"""Language ID: script ranges narrow the candidates, Viterbi over words labels spans.

*Training*: letter n-grams (1 to 4, with word ends) of a bounded sample of distinct labelled
texts (``train_docs`` in all, rare languages whole), hashed to 2^16 buckets and counted by language in Spark; words
are counted by script and language. The driver receives 2^16 counters a language.

*Prediction*: a word's script, from the ranges below, leaves the languages that use it;
each of these scores the word by its n-grams. Viterbi finds the best sequence of labels,
where a change of language costs ``switch_penalty``; all documents of a batch advance
together. Runs of a label are the spans; the language with most letters is the prediction,
its share of the letters, times its posterior among the document's languages, the score.

Nulls and texts without a letter: ``und`` with score 0, no spans. A null label is not
learned from. Without any labelled document all is ``und``. Equal texts fare alike; an
empty table gives an empty result; input columns travel in one struct.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelcat.llm.common import packed, small_batches, split_words, table
from reelcat.llm.pii import _shares

#: First code point of each range and its script; a range ends where the next begins.
SCRIPTS = [(0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
           (0x0900, "devanagari"), (0x0980, "indic"), (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"),
           (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "han"),
           (0xAC00, "hangul"), (0xD800, "other"), (0xF900, "han"), (0xFB00, "other")]
NAMES = sorted({s for _, s in SCRIPTS})
_FIRST = np.array([a for a, _ in SCRIPTS])
_KIND = np.array([NAMES.index(s) for _, s in SCRIPTS])
BITS, ORDERS = 16, 4
U = np.uint64
BATCH = 4 << 20
RULED_OUT = -40.0


@dataclass(frozen=True)
class Model:
    langs: list[str]
    scores: np.ndarray  # [buckets, languages], log probabilities
    allowed: np.ndarray  # [scripts, languages]


def _unique_words(texts: pa.Array):
    """(offsets, code of each word with a letter, its distinct letters-only forms, its place among all words)."""
    off, words = split_words(texts)
    coded = words.dictionary_encode()
    forms = pc.replace_substring_regex(pc.utf8_lower(coded.dictionary), r"[^\p{L}\p{M}]+", "")
    lettered = np.asarray(pc.match_substring_regex(forms, r"\p{L}"))
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) if len(words) else np.zeros(0, np.int64)
    keep = lettered[codes] if len(codes) else np.zeros(0, bool)
    place = np.flatnonzero(keep) - np.repeat(off[:-1], np.diff(off))[keep]
    return np.concatenate(([0], np.cumsum(keep)))[off], codes[keep], forms, place


def _grams(forms: list[str]):
    """(word of each n-gram, its bucket, script of each word, letters of each word); words marked at both ends."""
    marked = "".join(f"\x02{w}\x03" for w in forms)
    codes = np.frombuffer(marked.encode("utf-32-le"), np.uint32)
    sizes = np.fromiter((len(w) for w in forms), np.int64, len(forms))
    word = np.repeat(np.arange(len(forms)), sizes + 2)
    letter = codes > 3
    kinds = np.zeros((len(forms), len(NAMES)), np.int64)
    np.add.at(kinds, (word[letter], _KIND[np.searchsorted(_FIRST, codes[letter], "right") - 1]), 1)
    owners, buckets = [], []
    h = codes.astype(U) * U(0x9E3779B97F4A7C15)
    for n in range(1, ORDERS + 1):
        if n > 1:
            h = (h[:-1] ^ (h[:-1] >> U(29))) * U(0xBF58476D1CE4E5B9) + codes[n - 1 :].astype(U)
        if len(h) < 1:
            break
        inside = word[: len(h)] == word[n - 1 :]
        mixed = h[inside] * U(0x94D049BB133111EB) + U(n)
        owners.append(word[: len(h)][inside])
        buckets.append(((mixed ^ (mixed >> U(32))) * U(0x9E3779B97F4A7C15) >> U(64 - BITS)).astype(np.int64))
    return np.concatenate(owners), np.concatenate(buckets), kinds.argmax(1), sizes


def _counting(batches):
    """Labelled texts to counts (lang, kind, k, n): kind 0 counts bucket k, kind 1 words of script k."""
    total: dict[str, np.ndarray] = {}
    for batch in small_batches(batches, BATCH):
        off, codes, forms, _ = _unique_words(batch["t"])
        used, codes = np.unique(codes, return_inverse=True)
        if not len(used):
            continue
        word, bucket, script, _ = _grams(forms.take(pa.array(used)).to_pylist())
        lang = batch["lang"].dictionary_encode()
        of = np.repeat(lang.indices.to_numpy(zero_copy_only=False), np.diff(off))
        for k, name in enumerate(lang.dictionary.to_pylist()):
            times = np.bincount(codes[of == k], minlength=len(used))
            both = total.setdefault(name, np.zeros((1 << BITS) + len(NAMES), np.int64))
            both[: 1 << BITS] += np.bincount(bucket, weights=times[word], minlength=1 << BITS).astype(np.int64)
            both[1 << BITS :] += np.bincount(script, weights=times, minlength=len(NAMES)).astype(np.int64)
    for name, both in total.items():
        k = np.flatnonzero(both)
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(k)), pa.array(k.astype(np.int32)), pa.array(both[k])], names=["lang", "k", "n"])


def sampled(labelled: DataFrame, text: str = "text", lang: str = "lang", train_docs: int = 20_000) -> DataFrame:
    """(lang, t): about ``train_docs`` distinct labelled texts at most; a language's copies count once, rare languages are taken whole.

    Texts are drawn by their hash, by a share of each language's (estimated) distinct texts. Copies
    collapse before the exchange, so that a text in a third of all rows is one row of the sample.
    """
    df = labelled.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("t")).where("t IS NOT NULL AND lang IS NOT NULL")
    sizes = df.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("t"), 0.02).alias("n")).collect()
    share = _shares({r["lang"]: r["n"] for r in sizes}, train_docs)
    taken = F.lit(0.0)
    if share:
        taken = F.element_at(F.create_map(*[c for k, v in share.items() for c in (F.lit(k), F.lit(float(v)))]), F.col("lang"))
    return df.where(F.pmod(F.xxhash64("t"), F.lit(1_000_000_000)) < taken * 1_000_000_000).distinct()


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", train_docs: int = 20_000) -> Model:
    """A model from the sample of ``sampled``."""
    df = sampled(labelled, text, lang, train_docs).select("t", "lang")
    got = df.mapInArrow(_counting, "lang string, k int, n bigint").groupBy("lang", "k").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(got["lang"].unique())
    counts = np.zeros(((1 << BITS) + len(NAMES), len(langs)))
    counts[got["k"].to_numpy(), np.searchsorted(langs, got["lang"].to_numpy(str)) if langs else []] = got["n"].to_numpy(float)
    grams, scripts = counts[: 1 << BITS] + 0.1, counts[1 << BITS :]
    allowed = scripts >= 0.001 * scripts.sum(0, keepdims=True)
    allowed[~allowed.any(1)] = True  # a script that nobody taught rules nobody out
    return Model(langs, np.log(grams / grams.sum(0)).astype(np.float32) if langs else grams, allowed)


def viterbi(scores: np.ndarray, code: np.ndarray, off: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of each word; ``scores`` [distinct words, languages]; all texts advance together."""
    n_langs = scores.shape[1]
    sizes = np.diff(off)
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = off[:-1][order], sizes[order]
    back = np.zeros((len(code), n_langs), np.int16)
    own = np.arange(n_langs, dtype=np.int16)
    delta = np.zeros((len(starts), n_langs), np.float32)
    longest = int(sizes[0]) if len(sizes) else 0
    alive = np.searchsorted(-sizes, -np.arange(longest), "left")  # texts with more than t words
    for t in range(longest):
        k = alive[t]
        at = starts[:k] + t
        d = delta[:k]
        if t:
            top = d.max(1, keepdims=True) - penalty
            stay = d >= top
            back[at] = np.where(stay, own, d.argmax(1).astype(np.int16)[:, None])
            np.maximum(d, top, out=d)
        d += scores[code[at]]
    label = np.zeros(len(code), np.int16)
    state = delta.argmax(1)
    for t in range(longest - 1, -1, -1):
        k = alive[t]
        at = starts[:k] + t
        label[at] = state[:k]
        state[:k] = back[at, state[:k]]
    return label


def _labelling(text: str, told, penalty: float):
    def run(batches):
        model = told.value
        langs = model.langs
        kinds = [pa.string(), pa.float64(), pa.list_(pa.struct([("first_word", pa.int32()), ("last_word", pa.int32()), ("lang", pa.string())]))]
        for batch in small_batches(batches, BATCH):
            off, codes, forms, place = _unique_words(pc.fill_null(pc.struct_field(batch["row"], [text]), ""))
            n = batch.num_rows
            pred, score, spans = ["und"] * n, [0.0] * n, [[] for _ in range(n)]
            if len(codes) and langs:
                used, codes = np.unique(codes, return_inverse=True)
                word, bucket, script, letters = _grams(forms.take(pa.array(used)).to_pylist())
                by_word = np.stack([np.bincount(word, weights=model.scores[bucket, k], minlength=len(used)) for k in range(len(langs))], 1)
                by_word = np.maximum((by_word - by_word.max(1, keepdims=True)) / ORDERS, RULED_OUT)
                by_word = (by_word + np.where(model.allowed[script], 0, RULED_OUT)).astype(np.float32)
                label = viterbi(by_word, codes, off, penalty)
                doc = np.repeat(np.arange(n), np.diff(off))
                share = np.bincount(doc * len(langs) + label, weights=letters[codes], minlength=n * len(langs)).reshape(n, -1)
                fit = np.stack([np.bincount(doc, weights=by_word[codes, k], minlength=n) for k in range(len(langs))], 1)
                fit = np.exp(np.maximum((fit - fit.max(1, keepdims=True)) / np.sqrt(np.maximum(np.diff(off), 1))[:, None], -50))
                best = share.argmax(1)
                some = np.flatnonzero(np.diff(off) > 0)
                got = share[some, best[some]] / share[some].sum(1) * fit[some, best[some]] / fit[some].sum(1)
                for i, s in zip(some.tolist(), got.tolist()):
                    pred[i], score[i] = langs[best[i]], s
                cut = np.ones(len(label), bool)
                cut[1:] = (label[1:] != label[:-1]) | (doc[1:] != doc[:-1])
                a = np.flatnonzero(cut)
                b = np.append(a[1:], len(label)) - 1
                for i, x, y, k in zip(doc[a].tolist(), place[a].tolist(), place[b].tolist(), label[a].tolist()):
                    spans[i].append({"first_word": x, "last_word": y, "lang": langs[k]})
            yield pa.RecordBatch.from_arrays([batch["row"], *map(pa.array, (pred, score, spans), kinds)], names=["row", "lang_pred", "score", "spans"])

    return run


def label_languages(docs: DataFrame, model: Model, text: str = "text", switch_penalty: float = 8.0) -> DataFrame:
    """(row, lang_pred, score, spans): spans are runs of words, by their place among the text's words."""
    df = packed(docs)
    told = docs.sparkSession.sparkContext.broadcast(model)
    out = (f"row {df.schema['row'].dataType.simpleString()}, lang_pred string, score double, "
           "spans array<struct<first_word:int,last_word:int,lang:string>>")
    return df.mapInArrow(_labelling(text, told, switch_penalty), out)


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2))
    out = label_languages(docs.select("doc_id", "text"), model)
    return out.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score")
