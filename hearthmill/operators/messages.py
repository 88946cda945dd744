"""E-mail messages to bill records.

Only MIME decoding and the HTML walk run in Python, in Arrow batches; the body
choice, the total and the subject are finished by column expressions.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator
from email import message_from_bytes, policy
from email.utils import parsedate_to_datetime
from html import unescape
from html.entities import html5
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthmill.functions import money, text

# Elements whose text is not shown, and elements without content.
_HIDDEN = {"script", "style", "template", "rt", "rp"}
_VOID = {
    "area", "base", "basefont", "bgsound", "br", "col", "command", "embed", "frame", "hr", "image",
    "img", "input", "isindex", "keygen", "link", "menuitem", "meta", "nextid", "param", "source",
    "spacer", "track", "wbr",
}

_DECODED = pa.schema(
    [
        ("message_date", pa.string()),
        ("message_subject", pa.string()),
        ("plain_parts", pa.list_(pa.string())),
        ("html_parts", pa.list_(pa.string())),
        ("error", pa.string()),
    ]
)
_DECODED_DDL = (
    "message_date string, message_subject string, plain_parts array<string>, "
    "html_parts array<string>, error string"
)

# Workers then need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class _TextNodes(HTMLParser):
    """Collects text nodes outside hidden elements."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.nodes, self.pending, self.open, self.depth = [], [], [], Counter()

    def flush(self):
        node = "".join(self.pending).strip()
        if node and not any(self.depth[tag] for tag in _HIDDEN):
            self.nodes.append(node)
        self.pending = []

    def handle_data(self, data):
        self.pending.append(data)

    def handle_charref(self, name):
        self.pending.append(unescape(f"&#{name};"))

    def handle_entityref(self, name):
        # A known entity needs no semicolon; an unknown one loses it.
        self.pending.append(html5.get(f"{name};", f"&{name}"))

    def handle_starttag(self, tag, attrs):
        self.flush()
        if tag not in _VOID:
            self.open.append(tag)
            self.depth[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.flush()

    def handle_endtag(self, tag):
        self.flush()
        closed = None
        while self.depth[tag] and closed != tag:
            closed = self.open.pop()
            self.depth[closed] -= 1

    def handle_comment(self, data):
        self.flush()

    handle_decl = handle_pi = unknown_decl = handle_comment


def visible_text(html: str) -> str:
    parser = _TextNodes()
    parser.feed(html)
    parser.close()
    parser.flush()
    return "\n".join(parser.nodes)


def _clean(decoded: str) -> str:
    """Text that UTF-8 can hold: half characters become question marks."""
    return decoded.encode("utf-8", errors="replace").decode("utf-8")


def _part_text(part) -> str:
    payload = part.get_payload(decode=True)
    if payload is None:
        raw = part.get_payload()
        return _clean(raw) if isinstance(raw, str) else ""
    try:
        return _clean(payload.decode(part.get_content_charset() or "utf-8", errors="replace"))
    except LookupError:
        return payload.decode("utf-8", errors="replace")


def _iso_date(header: str | None) -> str | None:
    try:
        return parsedate_to_datetime(header).date().isoformat() if header else None
    except (TypeError, ValueError, IndexError, OverflowError):
        return None


def _decode(content: bytes) -> tuple:
    message = message_from_bytes(content, policy=policy.default)
    if not message.keys():
        raise ValueError("no message headers")
    leaves = [part for part in message.walk() if not part.is_multipart()]
    plain = [_part_text(part) for part in leaves if part.get_content_type() == "text/plain"]
    html = [] if plain else [
        _clean(visible_text(_part_text(part))) for part in leaves if part.get_content_type() == "text/html"
    ]
    subject = message.get("Subject")
    return (
        _iso_date(message.get("Date")),
        None if subject is None else _clean(str(subject)),
        plain,
        html,
        None,
    )


def _decode_or_reject(content: bytes) -> tuple:
    try:
        return _decode(content)
    except Exception as problem:  # one bad document must not end the batch
        return (None, None, None, None, f"{type(problem).__name__}: {problem}")


def _decode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the last column, the message bytes, by what they decode to."""
    for batch in batches:
        decoded = [_decode_or_reject(content.as_py()) for content in batch.columns[-1]]
        columns = zip(*decoded) if decoded else [[]] * len(_DECODED)
        arrays = [pa.array(list(c), kind) for c, kind in zip(columns, _DECODED.types, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], *arrays], names=[*batch.schema.names[:-1], *_DECODED.names]
        )


def extract_bills(documents: DataFrame, content: str = "content") -> DataFrame:
    """One bill per message, or its ``error``; other columns pass through."""
    kept = [field for field in documents.schema.fields if field.name != content]
    names = [field.name for field in kept]
    schema = T.StructType(kept + T.StructType.fromDDL(_DECODED_DDL).fields)
    decoded = documents.select(*names, content).mapInArrow(_decode_batches, schema)
    plain, html = F.col("plain_parts"), F.col("html_parts")
    body = F.when(F.size(plain) > 0, F.array_join(plain, "\n")).otherwise(F.array_join(html, "\n"))
    return decoded.withColumn("raw_body_text", F.when(F.col("error").isNull(), body)).select(
        *names,
        F.col("message_date").alias("date"),
        text.blank_to_null(F.col("message_subject")).alias("subject"),
        money.bill_total(F.col("raw_body_text")).alias("total_amount"),
        "raw_body_text",
        "error",
    )
