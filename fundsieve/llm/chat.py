"""Conversations as one training text each, from typed content parts.

A turn's content is a list of parts: text, image, audio or document. A visitor flattens it to text with an ordered
placeholder for each attachment and records the attachment's reference and how many tokens it takes when it is expanded.
The template puts marks around turns; control strings inside texts and roles are escaped so that they can be read back.
Formatting is one fragment a turn, so no conversation is gathered: offsets come from running sums over its turns. The
loss mask is the span of each assistant's content. Reading parses the fragments of a conversation as one stream, in which
only the unfinished turn is held; a conversation's hash needs its texts one after another, so they stream through one
task, some at a time.

Cases: null texts and roles are empty; turns are ordered by turn (null first), then role, then content, so rows with the
same turn have a defined order and repeated rows repeat; rows with a null conv_id are one conversation; any role is kept,
also one that the template does not know; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundsieve.llm.tables import small_batches

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
ATTACHMENT = "struct<kind:string,ref:string,place:int,tokens:long>"
# The marks of turns, in the form that instruction-tuned models use. A role without marks of its own stands in TURN.
MARKS = {"user": ("<s>[INST] ", " [/INST]"), "system": ("<s>[SYS] ", " [/SYS]"), "assistant": (" ", "</s>")}
CONTROL = re.compile(r"(<(?=/?s>)|\[(?=/?(?:INST|SYS|TURN|IMAGE|AUDIO|DOCUMENT)[ \]]))")
ESCAPED = re.compile(r"\\(\\?)")
TURN = re.compile(r"<s>\[(INST|SYS)\] (.*?) \[/\1\]|<s>\[TURN ([^\]]*)\] (.*?) \[/TURN\]| (.*?)</s>", re.S)
PLACE = re.compile(r"\[(IMAGE|AUDIO|DOCUMENT) (\d+)\]")
NAMES = {"INST": "user", "SYS": "system"}
PATCH, FRAMES, PAGE = 28, 12.5, 600  # an image's patch in pixels, an audio's tokens a second, a document's tokens a page


def escape(text: str) -> str:
    """Backslashes doubled, and one behind the first character of every control string."""
    return CONTROL.sub(r"\1\\", text.replace("\\", "\\\\")) if "\\" in text or "<" in text or "[" in text else text


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text) if "\\" in text else text


class Flatten:
    """The visitor: one method for each type of part; it returns the text and records attachments in their order."""

    def __init__(self, count_text=None):
        self.count_text = count_text
        self.attachments: list[tuple[str, str, int, int]] = []
        self.tokens = 0

    def visit(self, part: dict) -> str:
        kind = part.get("type") or "text"
        if kind not in ("text", "image", "audio", "document"):
            raise ValueError(f"unknown part: {kind}")
        return getattr(self, kind)(part)

    def text(self, part: dict) -> str:
        text = part.get("text") or ""
        self.tokens += self.count_text(text) if self.count_text else 0
        return escape(text)

    def attach(self, kind: str, part: dict, tokens: int) -> str:
        place = len(self.attachments)
        self.attachments.append((kind, part.get("ref") or "", place, tokens))
        self.tokens += tokens
        return f"[{kind.upper()} {place}]"

    def image(self, part: dict) -> str:
        return self.attach("image", part, math.ceil((part.get("width") or 0) / PATCH) * math.ceil((part.get("height") or 0) / PATCH))

    def audio(self, part: dict) -> str:
        return self.attach("audio", part, math.ceil((part.get("seconds") or 0) * FRAMES))

    def document(self, part: dict) -> str:
        return self.attach("document", part, (part.get("pages") or 0) * PAGE)


def wrap(role: str, content: str) -> tuple[str, int]:
    """A turn's fragment and where its content begins."""
    if role in MARKS:
        head, tail = MARKS[role]
    else:
        # The role's own brackets are written out of the way as well, so that the mark ends at its first one.
        head, tail = f"<s>[TURN {escape(role).replace('%', '%25').replace(']', '%5D')}] ", " [/TURN]"
    return head + content + tail, len(head)


def parse(fragments):
    """(role, escaped content, span of the content) of each turn of a stream of formatted text cut anywhere."""
    rest, at = "", 0
    for fragment in fragments:
        rest += fragment
        done = 0
        while m := TURN.match(rest, done):
            name, plain, role, other, reply = m.groups()
            which = 2 if name else 4 if role is not None else 5
            who = NAMES[name] if name else "assistant" if role is None else unescape(role.replace("%5D", "]").replace("%25", "%"))
            yield who, m[which], at + m.start(which), at + m.end(which)
            done = m.end()
        rest, at = rest[done:], at + done
    if rest:
        raise ValueError("formatted text ends inside a turn")


def content(escaped: str, attachments: list[tuple] = ()) -> list[dict]:
    """The parts of a turn, read back: texts, and attachments by their placeholders."""
    out, at = [], 0
    for m in PLACE.finditer(escaped):
        if m.start() > at:
            out.append({"type": "text", "text": unescape(escaped[at : m.start()])})
        kind, ref, *_ = attachments[int(m[2])]
        out.append({"type": kind, "ref": ref})
        at = m.end()
    if at < len(escaped) or not out:
        out.append({"type": "text", "text": unescape(escaped[at:])})
    return out


def of_texts(conversations: DataFrame) -> DataFrame:
    """Turns with one text part each, from a text column."""
    part = F.struct(F.lit("text").alias("type"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *[F.lit(None).cast(t).alias(c) for c, t in (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))])
    return conversations.select("conv_id", "turn", "role", F.array(part).cast(f"array<{PART}>").alias("parts"))


def format_turns(turns: DataFrame, bpe: tuple[str, str] | None = None) -> DataFrame:
    """(conv_id, turn, role, fragment, content_at, content_chars, chars, loss, attachments, tokens) of turns(conv_id, turn, role, parts).

    bpe: vocabulary path and pattern to count the tokens of texts by; without, tokens are those of attachments alone.
    """

    def run(batches):
        count = None
        if bpe:
            from fundsieve.llm.bpe import Codec

            codec = Codec.get(*bpe)
            count = lambda text: len(codec.encode([text])[0].ids)
        schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("fragment", pa.string()), ("content_at", pa.int64()), ("content_chars", pa.int64()), ("chars", pa.int64()), ("loss", pa.bool_()), ("attachments", pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("place", pa.int32()), ("tokens", pa.int64())]))), ("tokens", pa.int64())])
        for b in batches:
            rows = []
            for conv, turn, role, parts in zip(*(c.to_pylist() for c in b.columns), strict=True):
                visitor = Flatten(count)
                body = "".join(map(visitor.visit, parts or []))
                fragment, at = wrap(role, body)
                seen = [dict(zip(("kind", "ref", "place", "tokens"), a, strict=True)) for a in visitor.attachments]
                rows.append((conv, turn, role, fragment, at, len(body), len(fragment), role == "assistant", seen, visitor.tokens))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    role = F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role")
    rows = small_batches(turns).select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), role, F.col("parts").cast(f"array<{PART}>"))
    return rows.mapInArrow(run, f"conv_id long, turn long, role string, fragment string, content_at long, content_chars long, chars long, loss boolean, attachments array<{ATTACHMENT}>, tokens long")


ORDER = ["turn", "role", "fragment"]


def loss_spans(formatted: DataFrame) -> DataFrame:
    """(conv_id, start, end): the spans of a conversation's text under the loss mask, by running sums of the fragments' lengths."""
    before = Window.partitionBy("conv_id").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum("chars").over(before), F.lit(0)) + F.col("content_at")
    return formatted.withColumn("start", at).where("loss").select("conv_id", "start", (F.col("start") + F.col("content_chars")).alias("end"))


def digests(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), parsed from the formatted text and cut out of it by the loss mask."""

    def run(batches):
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        out = []

        def put():
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for conv, own in groupby(rows, key=lambda r: r[0]):
            n = chars = loss_chars = 0
            turns, loss = hashlib.sha256(), hashlib.sha256()

            def fragments():
                nonlocal chars, loss_chars
                for _, fragment, start, size, masked in own:
                    if masked:  # the mask's span within what has been written so far
                        text = unescape(fragment[start : start + size])
                        loss_chars += len(text)
                        loss.update(text.encode())
                    chars += len(fragment)
                    yield fragment

            for role, escaped, *_ in parse(fragments()):
                turns.update(f"{role}\n{unescape(escaped)}\n".encode())
                n += 1
            out.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
            if len(out) == 5000:
                yield put()
                out.clear()
        if out:
            yield put()

    dealt = formatted.repartition("conv_id").sortWithinPartitions("conv_id", *ORDER)
    return dealt.select("conv_id", "fragment", "content_at", "content_chars", "loss").mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
