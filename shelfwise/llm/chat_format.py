"""Chat formatting with offset-aligned loss masks.

A whole conversation is rendered with a template and encoded once, with offsets. The spans of the turns and of the
tokens are both sorted, so binary search finds the tokens of each assistant turn: those carry the loss.

Template: `<s>` then, per turn, `[INST]role[/INST]text</s>`. The four control strings are tokens of their own, so no
token straddles a turn. Control strings inside texts and roles are escaped by a backslash after their first
character; one that already has backslashes there gets one more, so that removing one undoes it.

Turns are ordered by turn, then role and text (ties and repeated rows stay). Null roles and texts are empty, a null
conversation id is a conversation. An empty table gives none. One conversation is one row: its length is the
only bound. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import map_batches, table, written

TOKENIZER = "byte_bpe_50k.json"
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
TRAINED_ROLE = "assistant"

_PLAIN = re.compile(r"([<\[])(\\*)(/?s>|/?INST\])")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(/?s>|/?INST\])")
_TURN = re.compile(r"\[INST\](.*?)\[/INST\](.*?)</s>", re.DOTALL)


def escape(text: str) -> str:
    return _PLAIN.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the span of each turn's text in it."""
    parts, spans, at = ["<s>"], [], 3
    for role, text in turns:
        head, body = f"[INST]{escape(role)}[/INST]", escape(text)
        spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, "</s>"]
        at = spans[-1][1] + 4
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import AddedToken, Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True  # strings of the vocabulary's own special tokens are ordinary text
    t.add_tokens([AddedToken(c, normalized=False) for c in CONTROLS])
    return t


def covered(token_starts: np.ndarray, token_ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Mask of the tokens that lie in one of the sorted spans."""
    mask = np.zeros(len(token_starts), dtype=np.uint8)
    for start, end in spans:
        mask[bisect_left(token_starts, start) : bisect_left(token_ends, end + 1)] = 1
    return mask


def format_conversations(rows: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """conv_id, formatted text, token ids, the start and end of each token in the text, and the loss mask."""
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = rows.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def encode(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {k: [] for k in ("conv_id", "formatted", "ids", "starts", "ends", "loss")}
        for conv_id, turns in zip(cols["conv_id"], cols["turns"], strict=True):
            turns = [(t["role"], t["text"]) for t in turns]
            text, spans = render(turns)
            encoded = _tokenizer(path).encode(text, add_special_tokens=False)
            offsets = np.array(encoded.offsets, dtype=np.int64).reshape(-1, 2)
            wanted = [span for (role, _), span in zip(turns, spans, strict=True) if role == TRAINED_ROLE]
            mask = covered(offsets[:, 0], offsets[:, 1], wanted)
            for k, v in (("conv_id", conv_id), ("formatted", text), ("ids", encoded.ids), ("starts", offsets[:, 0]), ("ends", offsets[:, 1]), ("loss", mask)):
                out[k].append(v)
        return out

    kind = rows.schema["conv_id"].dataType.simpleString()
    return map_batches(whole, encode, f"conv_id {kind}, formatted string, ids array<int>, starts array<int>, ends array<int>, loss array<tinyint>", rows=100)


def _masked(formatted: str, starts: list[int], ends: list[int], loss: list[int]) -> Iterator[str]:
    """The text under each run of masked tokens; tokens of one character's bytes share its offsets."""
    begin = end = None
    for s, e, on in zip(starts, ends, loss, strict=True):
        if on:
            begin, end = (s if begin is None else begin), e
        elif begin is not None:
            yield unescape(formatted[begin:end])
            begin = None
    if begin is not None:
        yield unescape(formatted[begin:end])


def read_back(rows: DataFrame) -> DataFrame:
    """Digests of formatted conversations: their turns, and what lies under the loss mask."""

    def digest(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {k: [] for k in ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens", "n_loss_tokens")}
        for conv_id, text, ids, starts, ends, loss in zip(*(cols[k] for k in ("conv_id", "formatted", "ids", "starts", "ends", "loss")), strict=True):
            turns, under = parse(text), "".join(_masked(text, starts, ends, loss))
            said = "".join(f"{role}\n{body}\n" for role, body in turns)
            values = (conv_id, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(under), hashlib.sha256(under.encode()).hexdigest(), len(text), len(ids), sum(loss))
            for k, v in zip(out, values, strict=True):
                out[k].append(v)
        return out

    kind = rows.schema["conv_id"].dataType.simpleString()
    return map_batches(rows, digest, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long, n_loss_tokens long", rows=100)


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.sql(f"SELECT -1L AS conv_id, n AS turn, r AS role, '{probe}' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS v(n, r)")
    back = read_back(written(format_conversations(rows.unionByName(extra)), "chat"))
    return back.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


OP10_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g') AS et, regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g') AS er FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
    (3 + sum(17 + length(er) + length(et)))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
