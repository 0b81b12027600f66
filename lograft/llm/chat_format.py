"""Chat formatting by token-level assembly.

Every turn's role and text are encoded on their own, and reserved ids, which no
text can yield, are spliced between them; a conversation is the concatenation of
its turns' ids. Where a turn starts, and where loss counts in it, are prefix sums of
lengths. Control strings that occur inside a text are escaped before encoding,
reversibly, so that the formatted text can be split again as well.

The output is a Parquet table with a row per turn, in the order of the
conversations and turns: a conversation of any length is never held as one
value, and ``read_chat`` streams it.
"""

from __future__ import annotations

import hashlib
import re
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import ready_workers

#: The template's control strings; their ids follow the vocabulary in this order.
CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<ROLE>>", "<</ROLE>>"]
#: Ids of the vocabulary; reserved ids begin here.
VOCABULARY = 50256
_ID = {c: VOCABULARY + i for i, c in enumerate(CONTROLS)}
_OPEN = {"user": "[INST]", "system": "<<SYS>>", "assistant": "<s>"}
_CLOSE = {"user": "[/INST]", "system": "<</SYS>>", "assistant": "</s>"}
_ROLE_OF = {_ID[c]: r for r, c in _OPEN.items()}

_ESCAPE = re.compile("(" + "|".join(sorted({re.escape(c[0]) for c in CONTROLS})) + r")(\\*)(" + "|".join(re.escape(c[1:]) for c in CONTROLS) + ")")
_UNESCAPE = re.compile(_ESCAPE.pattern.replace(r"(\\*)", r"\\(\\*)"))
_WHOLE = frozenset(CONTROLS)


def escape(text: str) -> str:
    """A backslash after the first character of each control string, and one more
    where backslashes stand there already. The result has no control string."""
    return _ESCAPE.sub(lambda m: f"{m[1]}\\{m[2]}{m[3]}" if m[1] + m[3] in _WHOLE else m[0], text)


def unescape(text: str) -> str:
    """The text that ``escape`` was given."""
    return _UNESCAPE.sub(lambda m: f"{m[1]}{m[2]}{m[3]}" if m[1] + m[3] in _WHOLE else m[0], text)


_codecs: dict = {}


def _codec(ranks_path: str):
    if ranks_path not in _codecs:
        import base64

        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _codecs[ranks_path] = tiktoken.Encoding("chat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _codecs[ranks_path]


def _turn_ids(codec, role: str, text: str) -> tuple[list[int], int, int, int]:
    """Ids of a turn, the part of them that loss counts in, and the turn's characters."""
    if role in _OPEN:
        head, shown = [_ID[_OPEN[role]]], len(_OPEN[role])
    else:
        name = escape(role)
        head = [_ID["<<ROLE>>"], *codec.encode_ordinary(name), _ID["<</ROLE>>"]]
        shown = len("<<ROLE>>") + len(name) + len("<</ROLE>>")
    tail = _CLOSE.get(role, "</s>")
    body = escape(text)
    ids = codec.encode_ordinary(body)
    end = len(head) + len(ids)
    return [*head, *ids, _ID[tail]], len(head), end if role == "assistant" else len(head), shown + len(body) + len(tail)


def _format(batches, ranks_path: str):
    codec = _codec(ranks_path)
    for batch in batches:
        rows: list = []

        def out():
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays(
                [batch.column("conv_id").take(pa.array(cols[0])), batch.column("turn").take(pa.array(cols[0])), pa.array(cols[1], pa.string()),
                 pa.array(cols[2], pa.binary()), *(pa.array(c, pa.int64()) for c in cols[3:])],
                ["conv_id", "turn", "order", "ids", "n_ids", "loss_from", "loss_to", "chars"])

        held = 0
        for i, (role, text) in enumerate(zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())):
            ids, a, b, chars = _turn_ids(codec, role or "", text or "")
            packed = np.array(ids, np.uint16).tobytes()
            key = hashlib.md5((role or "").encode() + b"\n" + (text or "").encode()).hexdigest()
            rows.append((i, key, packed, len(ids), a, b, chars))
            held += len(packed)
            if held > 1 << 24:
                yield out()
                rows, held = [], 0
        if rows:
            yield out()


def format_chat(turns: DataFrame, ranks_path: str, path: str, conv_col: str = "conv_id", turn_col: str = "turn",
                role_col: str = "role", text_col: str = "text") -> None:
    """Write the formatted conversations to ``path`` (Parquet, a row per turn).

    Columns: conv_id, turn, seq (0, 1, ... in the conversation), start (ids before it
    in the conversation), ids (little-endian unsigned 16-bit), n_ids, loss_from and
    loss_to (ids of the conversation that loss counts in, end exclusive: the text of
    assistant turns), chars (of the formatted text).

    Turns go by ``turn``, nulls first; turns with the same number by a hash of role
    and text. Null roles and texts are empty. A role other than user, assistant and
    system is written out between reserved ids. Null conversation ids are one
    conversation. Repeated rows are turns of their own. No rows give an empty table.
    """
    ready_workers(turns.sparkSession)
    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                        F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    ids = rows.mapInArrow(partial(_format, ranks_path=ranks_path),
                          "conv_id long, turn long, order string, ids binary, n_ids long, loss_from long, loss_to long, chars long")
    line = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "order")
    (ids.withColumn("seq", F.row_number().over(line) - 1)
     .withColumn("start", F.sum("n_ids").over(line.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_ids"))
     .select("conv_id", "turn", "seq", "start", "ids", "n_ids", (F.col("start") + F.col("loss_from")).alias("loss_from"),
             (F.col("start") + F.col("loss_to")).alias("loss_to"), "chars")
     .write.mode("errorifexists").parquet(path))


def read_chat(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``format_chat`` wrote."""
    return spark.read.parquet(path)


def _parse(codec, ids: np.ndarray) -> tuple[str, str]:
    """Role and text of one turn, from its ids."""
    first = int(ids[0])
    if first in _ROLE_OF:
        role, at = _ROLE_OF[first], 1
    else:
        at = int(np.flatnonzero(ids == _ID["<</ROLE>>"])[0]) + 1
        role = unescape(codec.decode_bytes(ids[1: at - 1].tolist()).decode())
    return role, unescape(codec.decode_bytes(ids[at:-1].tolist()).decode())


class _Digest:
    def __init__(self, conv):
        self.conv, self.turns, self.chars, self.loss_chars, self.ids = conv, 0, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def row(self):
        return self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _digests(batches, ranks_path: str):
    """Rows sorted by (conv_id, seq); one conversation at a time, as running hashes."""
    codec, now = _codec(ranks_path), None
    for batch in batches:
        done = []
        cols = (batch.column(c).to_pylist() for c in ("conv_id", "start", "ids", "loss_from", "loss_to", "chars"))
        for conv, start, body, loss_from, loss_to, chars in zip(*cols):
            if now is None or conv != now.conv:
                if now is not None:
                    done.append(now.row())
                now = _Digest(conv)
            ids = np.frombuffer(body, np.uint16)
            if start != now.ids:
                raise ValueError(f"conversation {conv}: a turn starts at {start}, after {now.ids} ids")
            role, text = _parse(codec, ids)
            now.ids += len(ids)
            now.turns += 1
            now.chars += chars
            now.all.update(f"{role}\n{text}\n".encode())
            under = unescape(codec.decode_bytes(ids[loss_from - start: loss_to - start].tolist()).decode())
            now.loss_chars += len(under)
            now.loss.update(under.encode())
        yield _digest_batch(done)
    yield _digest_batch([now.row()] if now is not None else [])


def _digest_batch(rows: list) -> pa.RecordBatch:
    kinds = [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
             ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(kinds)], [n for n, _ in kinds])


def chat_digests(chat: DataFrame, ranks_path: str) -> DataFrame:
    """What formatted conversations say, read back from their ids: conv_id, n_turns,
    turns_sha256 (of role, newline, text, newline per turn), loss_chars and loss_sha256
    (of the text under the loss mask, unescaped), formatted_chars."""
    ready_workers(chat.sparkSession)
    return (chat.repartition("conv_id").sortWithinPartitions("conv_id", "seq")
            .mapInArrow(partial(_digests, ranks_path=ranks_path),
                        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"))
