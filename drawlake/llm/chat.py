"""Chat formatting: a finite-state machine over roles and a declarative template.

:func:`format_turns` emits text segments with loss flags, :func:`read_back`
parses their concatenation again. Control strings of the template are escaped
inside texts, so that reading back is exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drawlake.llm.common import partitions, prepare


@dataclass(frozen=True)
class Template:
    """What surrounds a turn, who may speak after whom and whose text bears loss.

    A turn reads ``open + role + between + text + close``. ``follows[state]``
    lists the roles allowed after ``state``; the empty state is the start.
    """

    open: str = "### "
    between: str = ": "
    close: str = " </turn>\n"
    escape: str = "\\"
    loss_roles: tuple[str, ...] = ("assistant",)
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})

    def shield(self, text: str, controls: tuple[str, ...]) -> str:
        """Escape characters are doubled and a control string is broken after its first character."""
        text = text.replace(self.escape, self.escape * 2)
        for c in controls:
            text = text.replace(c, c[0] + self.escape + c[1:])
        return text

    def bare(self, text: str) -> str:
        """Inverse of :meth:`shield`: drop each escape character and keep what follows it."""
        if self.escape not in text:
            return text
        out, parts = [], iter(text.split(self.escape))
        out.append(next(parts))
        for p in parts:
            if p == "":  # a doubled escape: the next part belongs to plain text
                out.append(self.escape)
                p = next(parts, "")
            out.append(p)
        return "".join(out)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """(text, bears loss) of one turn."""
        controls = (self.open, self.close.strip())
        head = self.open + self.shield(role, (*controls, self.between)) + self.between
        return [(head, False), (self.shield(text, controls), role in self.loss_roles), (self.close, False)]

    def parse(self, formatted: str, at: int = 0) -> tuple[str, str, int]:
        """Role, text and end of the turn that begins at ``at``."""
        if not formatted.startswith(self.open, at):
            raise ValueError(f"no turn begins at {at}")
        at += len(self.open)
        mid = formatted.index(self.between, at)
        role, at = formatted[at:mid], mid + len(self.between)
        # The text has no closing mark of its own, so the first one ends it.
        end = formatted.index(self.close.strip(), at) - (len(self.close) - len(self.close.lstrip()))
        return self.bare(role), self.bare(formatted[at:end]), end + len(self.close)


SEGMENTS = "conv_id long, turn_no long, part int, text string, loss boolean, valid boolean"
DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long, valid boolean")


def format_turns(turns: DataFrame, template: Template | None = None, conv_col: str = "conv_id",
                 turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Three segments per turn: opening, text and closing mark, with loss flags.

    ``valid`` says whether the conversation is in an order that the template
    allows up to and including this turn. A conversation out of order is
    formatted all the same. Conversations stream through their task turn by
    turn, so one that holds very many rows needs no more memory than a short one.

    Null text or role: empty. Rows with a null ``conv_id`` form one
    conversation. Turns go by ``turn`` (null first), then role and text, so
    repeated rows stay turns of their own in a fixed order. Empty table: empty.
    """
    prepare(turns.sparkSession)
    t = template or Template()
    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
                        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, state, ok, n = object(), "", True, 0
        for pdf in frames:
            out = []
            ids = pdf["conv_id"].astype("Int64")
            for c, role, text in zip(ids, pdf["role"], pdf["text"], strict=True):
                c = None if c is pd.NA else int(c)
                if c != conv:
                    conv, state, ok, n = c, "", True, 0
                ok = ok and role in t.follows.get(state, ())
                state = role
                out.extend((c, n, k, s, loss, ok) for k, (s, loss) in enumerate(t.segments(role, text)))
                n += 1
            got = pd.DataFrame(out, columns=["conv_id", "turn_no", "part", "text", "loss", "valid"])
            yield got.astype({"conv_id": "Int64"})

    return (rows.repartition(partitions(turns.sparkSession), "conv_id")
            .sortWithinPartitions("conv_id", "turn", "role", "text").mapInPandas(run, SEGMENTS))


def read_back(segments: DataFrame, template: Template | None = None) -> DataFrame:
    """One row per conversation, from the formatted text alone.

    Parses the concatenated segments, as :func:`format_turns` emits them (a
    conversation's segments in order and in one partition), and returns
    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars,
    valid``. Only the segments' flags say what bears loss.
    """
    t = template or Template()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, now = object(), None

        def done():
            return [] if now is None else [(conv, now["n"], now["turns"].hexdigest(), now["chars"],
                                            now["loss"].hexdigest(), now["length"], now["valid"])]

        for pdf in frames:
            out = []
            ids = pdf["conv_id"].astype("Int64")
            for c, part, text, loss, valid in zip(ids, pdf["part"], pdf["text"], pdf["loss"], pdf["valid"], strict=True):
                c = None if c is pd.NA else int(c)
                if c != conv or now is None:
                    out.extend(done())
                    conv, now = c, {"n": 0, "chars": 0, "length": 0, "valid": True, "open": "", "turns": hashlib.sha256(),
                                    "loss": hashlib.sha256()}
                now["open"] += text
                now["length"] += len(text)
                now["valid"] = bool(valid)
                if loss:
                    bare = t.bare(text)
                    now["chars"] += len(bare)
                    now["loss"].update(bare.encode())
                if part == 2:  # a whole turn lies open: read it
                    role, said, end = t.parse(now["open"])
                    now["turns"].update(f"{role}\n{said}\n".encode())
                    now["n"] += 1
                    now["open"] = now["open"][end:]
            yield _digests(out)
        yield _digests(done())

    return segments.mapInPandas(run, DIGESTS)


def _digests(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                                      "formatted_chars", "valid"])
    return out.astype({"conv_id": "Int64", "valid": bool})
