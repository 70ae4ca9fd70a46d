"""Chat formatting: whole conversations rendered and encoded once, with an offset-aligned loss mask.

A conversation is ``<s>`` and, per turn, ``[INST]role[/INST]text</s>``. Control strings inside
roles and texts get a backslash after their first character (``<\\/s>``), and those that
have backslashes there already get one more, so the escape is undone exactly. The
control strings are special tokens: no token crosses from a turn's text into a marker.

The rendered text is encoded once, with offsets; the sorted spans of the turns are
intersected with the tokens' spans by binary search, and a token that begins inside an
assistant's text is under the loss.

Turns are sorted within their partition (turn, role, text; nulls first) and streamed, so a
task holds one part of one conversation: a conversation over ``part_chars`` goes on in a
further row (``part`` 1, 2, ...), which changes no token because turns never share one.

Nulls: null roles and texts are empty; a null conversation id is one conversation, and
comes out with a null id. Repeated rows are turns of their own. An empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelcat.llm.common import table

MODEL = "/opt/tokenizers/byte_bpe_50k.json"
BEGIN, ROLE, TEXT, END = "<s>", "[INST]", "[/INST]", "</s>"
CONTROLS = [BEGIN, ROLE, TEXT, END, "<|endoftext|>"]
_REST = "|".join(re.escape(c[1:]) for c in CONTROLS)
_ESCAPE = re.compile(rf"([<\[])(\\*)(?={_REST})")
_UNESCAPE = re.compile(rf"([<\[])\\(\\*)(?={_REST})")
_TURN = re.compile(r"\[INST\](.*?)\[/INST\](.*?)</s>", re.DOTALL)
FORMATTED = ("conv_id bigint, part int, formatted string, token_ids array<int>, token_starts array<int>, token_ends array<int>, "
             "loss array<boolean>, turn_starts array<int>, turn_ends array<int>")


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a rendered conversation or part."""
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(formatted)]


def loss_mask(starts: np.ndarray, turn_starts: np.ndarray, turn_ends: np.ndarray, learned: np.ndarray) -> np.ndarray:
    """Whether each token begins in a learned turn's text; the turns' spans are sorted and disjoint."""
    if not len(turn_starts):
        return np.zeros(len(starts), bool)
    k = np.searchsorted(turn_starts, starts, "right") - 1
    inside = (k >= 0) & (starts < turn_ends[k])
    return inside & learned[k]


def _format(learned_role: str, part_chars: int, model):
    def run(batches):
        from tokenizers import Tokenizer

        tok = Tokenizer.from_str(model.value)
        tok.add_special_tokens(CONTROLS)
        conv, part, text, size, spans = object(), 0, [], 0, []
        done = []

        def row():
            formatted = "".join(text)
            e = tok.encode(formatted, add_special_tokens=False)
            a = np.array(spans, np.int64).reshape(-1, 3)
            offsets = np.array(e.offsets, np.int64).reshape(-1, 2)
            return (conv, part, formatted, e.ids, offsets[:, 0], offsets[:, 1], loss_mask(offsets[:, 0], a[:, 0], a[:, 1], a[:, 2] > 0), a[:, 0], a[:, 1])

        def out():
            kinds = [pa.int64(), pa.int32(), pa.string(), *[pa.list_(pa.int32())] * 3, pa.list_(pa.bool_()), *[pa.list_(pa.int32())] * 2]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=[x.split()[0] for x in FORMATTED.split(", ")])

        held = 0
        for batch in batches:
            for c, role, said in zip(*(batch[x].to_pylist() for x in ("conv_id", "role", "text"))):
                new = c != conv or not text
                if text and (c != conv or size >= part_chars):
                    done.append(row())
                    held += size
                    part = 0 if c != conv else part + 1
                    text, size, spans = [], 0, []
                if new:
                    conv, part = c, 0
                    text, size = [BEGIN], len(BEGIN)
                head, body = f"{ROLE}{escape(role)}{TEXT}", escape(said)
                spans.append((size + len(head), size + len(head) + len(body), int(role == learned_role)))
                text += [head, body, END]
                size += len(head) + len(body) + len(END)
                if held > 1 << 21:
                    yield out()
                    done, held = [], 0
        if text:
            done.append(row())
        if done:
            yield out()

    return run


def formatted(conversations: DataFrame, learned_role: str = "assistant", model: str = MODEL, part_chars: int = 1 << 22) -> DataFrame:
    """FORMATTED: one row per conversation (and part), in order within each partition."""
    with open(model, encoding="utf-8") as f:
        told = conversations.sparkSession.sparkContext.broadcast(f.read())
    none = F.lit("")
    turns = conversations.select(F.col("conv_id").cast("long"), "turn", F.coalesce("role", none).alias("role"), F.coalesce("text", none).alias("text"))
    turns = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return turns.drop("turn").mapInArrow(_format(learned_role, part_chars, told), FORMATTED)


DIGEST = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, n_tokens bigint"


def _read_back(batches):
    """The digest of each conversation from its rows (parts follow each other), read from the output alone."""
    held, done = None, []
    names = ("conv_id", "part", "formatted", "token_starts", "token_ends", "loss")

    def out():
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k in (2, 4) else pa.int64()) for k, c in enumerate(zip(*done))],
                                          names=[x.split()[0] for x in DIGEST.split(", ")])

    def end():
        done.append((held[0], held[1], held[2].hexdigest(), held[3], held[4].hexdigest(), held[5], held[6]))

    for batch in batches:
        for i in range(batch.num_rows):
            conv, part, text, starts, ends, loss = (batch[c][i] for c in names)
            if part.as_py() == 0:
                if held:
                    end()
                held = [conv.as_py(), 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
            text = text.as_py()
            for role, said in parse(text):
                held[1] += 1
                held[2].update(f"{role}\n{said}\n".encode())
            starts, ends, loss = (np.asarray(x.values.to_numpy(zero_copy_only=False)) for x in (starts, ends, loss))
            held[6] += len(starts)
            starts, ends = starts[loss], ends[loss]
            if len(starts):
                reach = np.maximum.accumulate(ends)  # the bytes of a character share its span
                first = np.flatnonzero(np.concatenate(([True], starts[1:] > reach[:-1])))
                for a, b in zip(starts[first].tolist(), reach[np.append(first[1:], len(starts)) - 1].tolist()):
                    under = unescape(text[a:b])
                    held[3] += len(under)
                    held[4].update(under.encode())
            held[5] += len(text)
        if len(done) > 4096:
            yield out()
            done.clear()
    if held:
        end()
    if done:
        yield out()


def digests(rows: DataFrame) -> DataFrame:
    return rows.mapInArrow(_read_back, DIGEST)


def op1_chat_formatting(spark, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return digests(formatted(turns.unionByName(own))).drop("n_tokens")


#: From the table itself; an escape adds one character to each control string.
ORACLE = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (3 + sum(17 + length(role || text) + len(regexp_extract_all(role || chr(10) || text, e))))::BIGINT AS formatted_chars
FROM c, (SELECT '[<\[]\\*(s>|/s>|INST\]|/INST\]|\|endoftext\|>)' AS e) GROUP BY conv_id
"""
