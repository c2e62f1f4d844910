"""Chat formatting on the level of tokens, with a loss mask, and reading it back.

Role and text of each turn are encoded on their own, and reserved ids, which no text can encode
to, are spliced between them: TURN role BODY text END. Written out, the reserved ids read as
control strings. The same strings inside a text are escaped before it is encoded, so that both
forms can be read back: each ``\\`` is doubled and ``<|`` becomes ``<\\|``. The loss mask is the
prefix sum of +1 where a masked text begins and -1 where it ends.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowproof.llm.text import bound_batches, share
from rowproof.llm.turn_chunks import arrow_schema, chunk_frame, folded, in_order
from rowproof.session import settle

#: All control strings begin so, and no escaped text holds it.
OPENER = "<|"
CONTROL = ("<|turn|>", "<|body|>", "<|end|>")


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace(OPENER, "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL) if "\\" in text else text


@dataclass
class ChatTemplate:
    """Assembles turns over a byte-pair vocabulary given as a file of ranks."""

    ranks: dict[bytes, int]
    pattern: str
    loss_roles: tuple[str, ...] = ("assistant",)
    roles: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def load(ranks_file: str, pattern: str, loss_roles: tuple[str, ...] = ("assistant",)) -> ChatTemplate:
        lines = Path(ranks_file).read_bytes().split(b"\n")
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, lines))}
        return ChatTemplate(ranks, pattern, loss_roles)

    @cached_property
    def reserved(self) -> tuple[int, int, int]:
        """Ids behind the vocabulary for TURN, BODY and END."""
        first = max(self.ranks.values()) + 1
        return first, first + 1, first + 2

    @cached_property
    def _encoding(self):
        import tiktoken

        return tiktoken.Encoding("chat", pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens={})

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self._encoding.encode_ordinary(escape(text)), np.uint32)

    def _role(self, role: str) -> np.ndarray:
        found = self.roles.get(role)
        if found is None:
            found = self._ids(role)
            if len(self.roles) < 10_000:
                self.roles[role] = found
        return found

    def assemble(self, turns: list[tuple[str, str]]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, loss mask) of some turns (role, text)."""
        turn, body, end = (np.array([k], np.uint32) for k in self.reserved)
        parts: list[np.ndarray] = []
        for role, text in turns:
            parts += [turn, self._role(role), body, self._ids(text), end]
        if not parts:
            return np.zeros(0, np.uint32), np.zeros(0, bool)
        ends = np.cumsum([len(p) for p in parts])
        ids = np.concatenate(parts)
        change = np.zeros(len(ids) + 1, np.int32)
        loss = np.flatnonzero([role in self.loss_roles for role, _ in turns])
        np.add.at(change, ends[5 * loss + 2], 1)
        np.add.at(change, ends[5 * loss + 3], -1)
        return ids, np.cumsum(change[:-1]) > 0

    def _text(self, ids: np.ndarray) -> str:
        return self._encoding.decode_bytes(ids.tolist()).decode("utf-8", "replace")

    def read(self, ids: np.ndarray, mask: np.ndarray) -> tuple[list[tuple[str, str]], str, int]:
        """(turns, text under the mask, characters of the formatted text), from ids and mask."""
        turn, body, end = (np.flatnonzero(ids == k).tolist() for k in self.reserved)
        turns, chars = [], 0
        for a, b, c in zip(turn, body, end, strict=True):
            role, text = self._text(ids[a + 1:b]), self._text(ids[b + 1:c])
            chars += len(role) + len(text) + sum(map(len, CONTROL))
            turns.append((unescape(role), unescape(text)))
        return turns, unescape(self._text(ids[mask])), chars

    def formatted(self, ids: np.ndarray) -> str:
        """The ids written out, reserved ones as control strings."""
        names, parts, last = dict(zip(self.reserved, CONTROL, strict=True)), [], 0
        for at in np.flatnonzero(ids >= self.reserved[0]).tolist():
            parts += [self._text(ids[last:at]), names[int(ids[at])]]
            last = at + 1
        return "".join([*parts, self._text(ids[last:])])

    def parse(self, formatted: str) -> list[tuple[str, str]]:
        """Turns of a formatted text."""
        turn, body, end = map(re.escape, CONTROL)
        found = re.findall(f"{turn}(.*?){body}(.*?){end}", formatted, flags=re.DOTALL)
        return [(unescape(role), unescape(text)) for role, text in found]


def format_chats(conversations: DataFrame, template: ChatTemplate) -> DataFrame:
    """Chunks (conv_id, part, k, whole, n_turns, ids, mask) of formatted conversations.

    Rows (conv_id, turn, role, text) go by turn, null turns first, rows of one turn by role and
    text hash; repeated rows are turns of their own. Null roles and texts count as empty, a null
    conv_id is a conversation like others. ``ids`` are packed little-endian unsigned 32-bit
    integers, ``mask`` one bit an id. A chunk holds whole turns; a conversation that is longer
    than a chunk has several, in order of part and k. Texts may be of any length, an empty table
    gives no rows, other columns are not read.
    """
    spark = conversations.sparkSession
    shared = share(spark, template)
    rows = conversations.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = settle(rows.withColumn("uid", F.monotonically_increasing_id()), "chat-turns")

    def build(turns: list[tuple]) -> dict:
        ids, mask = shared().assemble(turns)
        return {"n_turns": len(turns), "ids": ids.astype("<u4").tobytes(), "mask": np.packbits(mask).tobytes()}

    return chunk_frame(in_order(rows), ["role", "text"], build, "n_turns bigint, ids binary, mask binary")


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], "<u4") if row["ids"] else np.zeros(0, "<u4")
    return ids, np.unpackbits(np.frombuffer(row["mask"], np.uint8), count=len(ids)).astype(bool) if len(ids) else np.zeros(0, bool)


_REPORT = "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def chat_report(chunks: DataFrame, template: ChatTemplate) -> DataFrame:
    """One row per conversation, read back from ids and masks alone.

    Digests: of role, line feed, text, line feed for each turn, and of the text under the mask.
    Chunks are read in parallel; those of one conversation are then streamed in order through
    its two digests, which are one sequence each.
    """
    spark = chunks.sparkSession
    bound_batches(spark)
    shared = share(spark, template)
    kind = chunks.schema["conv_id"].dataType.simpleString()
    full = f"conv_id {kind}, part int, k int, whole boolean, turns binary, loss binary, {_REPORT}"
    arrow = arrow_schema(spark, full)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for r in batch.to_pylist():
                turns, loss, chars = shared().read(*_unpacked(r))
                said = "".join(f"{role}\n{text}\n" for role, text in turns).encode()
                out = {"conv_id": r["conv_id"], "part": r["part"], "k": r["k"], "whole": r["whole"],
                       "n_turns": len(turns), "loss_chars": len(loss), "formatted_chars": chars}
                if r["whole"]:
                    out |= {"turns_sha256": hashlib.sha256(said).hexdigest(), "loss_sha256": hashlib.sha256(loss.encode()).hexdigest()}
                else:
                    out |= {"turns": said, "loss": loss.encode()}
                made.append(out)
            yield pa.RecordBatch.from_pylist(made, arrow)

    pieces = settle(chunks.mapInArrow(read, full), "chat-pieces")

    def start() -> dict:
        return {"n_turns": 0, "loss_chars": 0, "formatted_chars": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256()}

    def step(s: dict, r: dict) -> None:
        for c in ("n_turns", "loss_chars", "formatted_chars"):
            s[c] += r[c]
        s["turns"].update(r["turns"])
        s["loss"].update(r["loss"])

    def finish(s: dict) -> dict:
        counts = {c: s[c] for c in ("n_turns", "loss_chars", "formatted_chars")}
        return counts | {"turns_sha256": s["turns"].hexdigest(), "loss_sha256": s["loss"].hexdigest()}

    several = pieces.filter("NOT whole").drop("whole", "turns_sha256", "loss_sha256")
    met = folded(several, ["part", "k"], start, step, finish, _REPORT)
    return pieces.filter("whole").select(met.columns).unionByName(met)
