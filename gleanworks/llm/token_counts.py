"""Token counts by section, from one encoding of each whole document.

A text is encoded once by a byte-level BPE; the tokens' byte spans follow from the lengths of
their ids' byte strings, and character spans from the text's encoding. Sections are half-open
character spans that cover the text; here a line with its end. Token spans meet sections by a
sorted search, text by text. A token that crosses a boundary belongs to one section by RULE:
`first` (the section of its first character), `last`, or `most` (the section with most of its
characters; of equal ones the first). So the counts of a text's sections sum to its tokens. A
token that holds a part of a character counts that character.

Nulls: a null or empty text has one empty section without tokens; a null id stays null. Very long
texts are encoded whole. Repeated rows give repeated rows. Empty input: an empty result. Extra
columns are ignored.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanworks.llm.common import text_groups
from gleanworks.session import table

RANKS = "byte_bpe_50k.tiktoken"
RULES = ("first", "last", "most")
GROUP_BYTES = 1 << 20
_encodings: dict[str, tuple] = {}


def ranks_path(name: str = RANKS) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoding(path: str):
    """(encode a text to ids, byte length of each id) for a file of ranks; one a process."""
    if path not in _encodings:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        size = np.zeros(max(ranks.values()) + 1, np.int64)
        size[list(ranks.values())] = [len(b) for b in ranks]
        made = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        _encodings[path] = made.encode_ordinary, size
    return _encodings[path]


def token_spans(text: str, ids: list[int], size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last character of each token."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    ends = np.cumsum(size[ids]) if ids else np.zeros(0, np.int64)
    char = np.cumsum((data & 0xC0) != 0x80) - 1
    return char[ends - size[ids]] if ids else ends, char[ends - 1] if ids else ends


def line_starts(text: str) -> np.ndarray:
    """Starts of the sections: lines, each with its end."""
    at = np.flatnonzero(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32) == 10) + 1
    return np.concatenate([[0], at[at < len(text)]])


def allocate(first: np.ndarray, last: np.ndarray, starts: np.ndarray, rule: str) -> np.ndarray:
    """Number of tokens of each section."""
    a, b = np.searchsorted(starts, first, "right") - 1, np.searchsorted(starts, last, "right") - 1
    own = b if rule == "last" else a
    if rule == "most":
        own = a.copy()
        for i in np.flatnonzero(a != b):
            edges = np.concatenate([[first[i]], starts[a[i] + 1 : b[i] + 1], [last[i] + 1]])
            own[i] = a[i] + np.diff(edges).argmax()
    return np.bincount(own, minlength=len(starts))


def section_tokens(docs: DataFrame, path: str, rule: str = "first", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, section, start, stop, n_tokens) for each section of each text."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    def count(batches):
        encode, size = encoding(path)
        for own, texts in text_groups(batches, GROUP_BYTES):
            held, sections, starts, stops, counts = [], [], [], [], []
            for doc, data in zip(own["doc_id"].to_pylist(), texts):
                text = data.decode(errors="replace")
                at = line_starts(text)
                held += [doc] * len(at)
                sections.append(np.arange(len(at), dtype=np.int32))
                starts.append(at)
                stops.append(np.append(at[1:], len(text)))
                counts.append(allocate(*token_spans(text, encode(text), size), at, rule))
            columns = [pa.array(held, pa.int64()), *(pa.array(np.concatenate(x)) for x in (sections, starts, stops, counts))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "section", "start", "stop", "n_tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(count, "doc_id long, section int, start long, stop long, n_tokens long")


def op7_section_tokens(spark, sf_dir):
    """The tokens of every line of every document."""
    return section_tokens(table(spark, sf_dir, "documents"), ranks_path())
