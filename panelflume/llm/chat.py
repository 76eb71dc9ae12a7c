"""Chat formatting: conversations rendered and encoded once, with loss masks aligned by offsets."""
from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
LOSS_ROLES = ("assistant",)
OPEN, MIDDLE, CLOSE = "<|turn|>", "<|says|>", "<|done|>"
PARSE = re.compile(re.escape(OPEN) + "(.*?)" + re.escape(MIDDLE) + "(.*?)" + re.escape(CLOSE), re.DOTALL)


def escape(text: str) -> str:
    """A text in which no control string occurs: a backslash parts every '<' from a '|'. unescape() undoes it."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def render(turns: list[tuple[str, str]], loss_roles: tuple[str, ...] = LOSS_ROLES) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the character spans of texts that carry loss, in order."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{escape(role)}{MIDDLE}", escape(text)
        if role in loss_roles and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    return [(unescape(r), unescape(t)) for r, t in PARSE.findall(formatted)]


def loss_pieces(offsets: list[tuple[int, int]], spans: list[tuple[int, int]]) -> tuple[list[int], list[tuple[int, int]]]:
    """Tokens that carry loss, and the character pieces they have of the spans.

    Offsets and spans are sorted: two binary searches find the tokens that meet a span. A token that reaches over a span's
    edge carries loss for its part inside. Tokens sharing a character (parts of its bytes) give it once.
    """
    starts, ends = [s for s, _ in offsets], [e for _, e in offsets]
    tokens, pieces = [], []
    for lo, hi in spans:
        first, last = bisect_right(ends, lo), bisect_left(starts, hi)
        for i in range(first, last):
            s, e = max(starts[i], lo), min(ends[i], hi)
            if s < e:
                tokens.append(i)
                if pieces and pieces[-1][1] >= s and pieces[-1][0] >= lo:
                    pieces[-1] = (pieces[-1][0], max(e, pieces[-1][1]))
                else:
                    pieces.append((s, e))
    return tokens, pieces


def format_conversations(turns: DataFrame, tokenizer_path: str = TOKENIZER, loss_roles: tuple[str, ...] = LOSS_ROLES) -> DataFrame:
    """turns (conv_id, turn, role, text) -> a row per conversation: conv_id, formatted, token_ids, loss_tokens (positions in
    token_ids that carry loss), loss_spans (character spans under the mask).

    Rows go by turn (null first), then role, then text; repeated rows are turns of their own. Null roles and texts are
    empty; an empty text carries no loss. A null conv_id is a conversation. Each conversation is encoded whole, once. An empty table
    gives an empty result; other columns do not matter. The vocabulary file is read by the driver and broadcast (its size
    is that of one vocabulary).
    """
    spark = turns.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        vocabulary = spark.sparkContext.broadcast(f.read())
    empty = F.lit("")
    rows = turns.select("conv_id", F.struct("turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text")).alias("row"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    whole = whole.select("conv_id", F.col("rows.role").alias("roles"), F.col("rows.text").alias("texts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer
        tokenizer = None
        for batch in batches:
            if tokenizer is None:
                tokenizer = Tokenizer.from_str(vocabulary.value)
                tokenizer.encode_special_tokens = True
            convs, roles, texts = (batch.column(i).to_pylist() for i in range(3))
            for at in range(0, len(convs), 256):
                part = slice(at, at + 256)
                done = [render(list(zip(r, t)), loss_roles) for r, t in zip(roles[part], texts[part])]
                coded = tokenizer.encode_batch([text for text, _ in done], add_special_tokens=False)
                masks = [loss_pieces(c.offsets, spans) for c, (_, spans) in zip(coded, done)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(convs[part], pa.int64()), pa.array([text for text, _ in done], pa.string()),
                    pa.array([c.ids for c in coded], pa.list_(pa.int32())), pa.array([m[0] for m in masks], pa.list_(pa.int32())),
                    pa.array([[{"start": s, "end": e} for s, e in m[1]] for m in masks],
                             pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
                    names=["conv_id", "formatted", "token_ids", "loss_tokens", "loss_spans"])

    return whole.withColumn("conv_id", F.col("conv_id").cast("long")).mapInArrow(
        run, "conv_id long, formatted string, token_ids array<int>, loss_tokens array<int>, loss_spans array<struct<start:int,end:int>>")


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from formatted conversations: turns, loss texts and their hashes."""
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                turns = parse(r["formatted"])
                loss = "".join(unescape(r["formatted"][s["start"]:s["end"]]) for s in r["loss_spans"])
                rows.append((r["conv_id"], len(turns), hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest(),
                             len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(r["formatted"]), r["n_tokens"], r["n_loss_tokens"]))
            cols = list(zip(*rows)) or [()] * 8
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)],
                                             names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars",
                                                    "n_tokens", "n_loss_tokens"])

    narrow = formatted.select("conv_id", "formatted", "loss_spans", F.size("token_ids").alias("n_tokens"),
                              F.size("loss_tokens").alias("n_loss_tokens"))
    return narrow.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                                  "formatted_chars long, n_tokens long, n_loss_tokens long")
