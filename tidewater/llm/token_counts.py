"""Tokens of a document's sections, from one encoding of the whole document.

The document is encoded once; tokens and sections are then joined as intervals of bytes. A token belongs to the section
that holds most of its bytes, to the earlier of two that hold equally many, and to the row with a NULL section if it lies
outside all of them. So the counts of a document add up to its tokens, which encoding the sections apart would not give.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.texts import ragged

_ENCODINGS: dict[tuple[str, str], tuple] = {}


def encoding_at(path: str, pattern: str):
    """The byte-level encoding of a file of ranks, and the bytes of each token; loaded once per worker process."""
    if (path, pattern) not in _ENCODINGS:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        size = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            size[rank] = len(token)
        _ENCODINGS[path, pattern] = (tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), size)
    return _ENCODINGS[path, pattern]


def encode_pieces(encoding, text: str, most: int = 1 << 20) -> np.ndarray:
    """Ids of the whole text. A text of over ``most`` characters goes to the encoder in pieces that end before a line
    break that follows a letter; the pattern splits there anyway, so the ids are those of the whole text."""
    if len(text) <= most:
        return np.asarray(encoding.encode_to_numpy(text, disallowed_special=()), np.int64)
    out, start = [], 0
    while start < len(text):
        end = min(len(text), start + most)
        while end < len(text) and not (text[end] == "\n" and text[end - 1].isalpha()):
            end += 1
        out.append(np.asarray(encoding.encode_to_numpy(text[start:end], disallowed_special=()), np.int64))
        start = end
    return np.concatenate(out)


def allocate(ends: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For tokens that end at ``ends`` (and begin where the last one ended): the section of each, and whether it crosses
    a boundary of the section. Sections are sorted and do not overlap; -1 is no section."""
    begins = np.concatenate(([0], ends[:-1]))
    low, high = np.searchsorted(stops, begins, "right"), np.searchsorted(starts, ends, "left")
    n = np.maximum(high - low, 0)
    token = np.repeat(np.arange(len(ends)), n)
    section = ragged(low, n)
    shared = np.minimum(ends[token], stops[section]) - np.maximum(begins[token], starts[section])
    chosen = np.full(len(ends), -1)
    order = np.lexsort((section, -shared, token))
    first = order[np.searchsorted(token, np.flatnonzero(n > 0))] if len(order) else order
    first = first[shared[first] > 0]
    chosen[token[first]] = section[first]
    held = np.zeros(len(ends), np.int64)
    held[token[first]] = shared[first]
    return chosen, (chosen >= 0) & (held < ends - begins)


def _byte_spans(text: str, spans: list[dict]) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
    """Names, and the byte bounds of the sections in order. A section that begins inside an earlier one begins where that ends."""
    raw = np.frombuffer(text.encode(), np.uint8)
    at = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
    limit = len(at) - 1
    clean = sorted((max(0, s["start"]), min(limit, s["end"]), i) for i, s in enumerate(spans) if s and s["start"] is not None and s["end"] is not None)
    names, begin, stop, chars, last = [], [], [], [], 0
    for a, b, i in clean:
        a = max(a, last)
        if a < b:
            names.append(spans[i]["name"])
            begin.append(at[a])
            stop.append(at[b])
            chars.append(b - a)
            last = b
    return names, np.array(begin, np.int64), np.array(stop, np.int64), np.array(chars, np.int64)


def token_counts(docs: DataFrame, sections: str, ranks_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document and section name: ``n_chars``, ``n_tokens`` and ``n_crossing`` (tokens of it that reach beyond it).

    ``sections`` is a column of ``array<struct<name, start, end>>`` in code points, end exclusive; sections of one name
    add up. Spans beyond the text are cut to it, NULL spans dropped. Every document has a row with a NULL section for what lies outside;
    NULL and empty texts have only that row, with zeros. Equal rows give equal rows. Other columns are not read.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    picked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), F.col(sections).alias("spans"))

    def count(batches):
        encoding, size = encoding_at(ranks_path, pattern)
        for batch in batches:
            doc, name, chars, tokens, crossing = [], [], [], [], []
            for i, (content, spans) in enumerate(zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist())):
                content = content or ""
                names, begin, stop, n_chars = _byte_spans(content, spans or [])
                ids = encode_pieces(encoding, content) if content else np.zeros(0, np.int64)
                chosen, crosses = allocate(np.cumsum(size[ids]), begin, stop)
                n = np.bincount(chosen + 1, minlength=len(names) + 1)
                x = np.bincount(chosen[crosses] + 1, minlength=len(names) + 1)
                sums = {None: [len(content) - int(n_chars.sum()), int(n[0]), 0]}
                for k, section in enumerate(names):
                    held = sums.setdefault(section, [0, 0, 0])
                    held[0] += int(n_chars[k])
                    held[1] += int(n[k + 1])
                    held[2] += int(x[k + 1])
                for section, (a, b, c) in sums.items():
                    doc.append(i)
                    name.append(section)
                    chars.append(a)
                    tokens.append(b)
                    crossing.append(c)
            columns = [batch.column("doc_id").take(pa.array(doc, pa.int64())), pa.array(name, pa.string()), pa.array(chars, pa.int64()), pa.array(tokens, pa.int64()), pa.array(crossing, pa.int64())]
            yield pa.record_batch(columns, names=["doc_id", "section", "n_chars", "n_tokens", "n_crossing"])

    return picked.mapInArrow(count, f"doc_id {kind}, section string, n_chars long, n_tokens long, n_crossing long")


def line_sections(text: str = "text"):
    """Sections of a text: its first line, its last line and what is between; line breaks belong to none."""
    t = F.coalesce(F.col(text), F.lit(""))
    n, first, last = F.length(t), F.locate("\n", t), F.locate("\n", F.reverse(t))

    def span(name, start, end):
        return F.struct(F.lit(name).alias("name"), start.cast("int").alias("start"), end.cast("int").alias("end"))

    one = F.array(span("first", F.lit(0), n))
    more = F.array(span("first", F.lit(0), first - 1), span("middle", first, n - last), span("last", n - last + 1, n))
    return F.when(first > 0, more).otherwise(one)
