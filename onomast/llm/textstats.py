"""Statistics of whole texts, counted over the bytes of an Arrow slice at once and per text over its words."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_slice, texts_of

SYMBOLS = b"#*$%&|<>"
#: Byte classes; every byte that begins a character counts in `char`.
CLASSES = {
    "char": [b for b in range(256) if not 0x80 <= b < 0xC0],
    "space": [9, 10, 11, 12, 13, 32],
    "upper": list(range(65, 91)),
    "lower": list(range(97, 123)),
    "digit": list(range(48, 58)),
    "symbol": list(SYMBOLS),
    "bang": list(b"!?"),
    "stop": list(b".,;:"),
    "pipe": list(b"|"),
    "line": [10],
}
FEATURES = [
    "log_words", "word_len", "upper_share", "lower_share", "digit_share", "symbol_share", "bang_share", "stop_share",
    "pipe_share", "other_share", "line_words", "distinct_words", "top_word", "dup_lines", "repeat_words", "longest_word",
]
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def class_counts(data: list[bytes]) -> dict[str, np.ndarray]:
    """For each class, its bytes in each of the texts."""
    size = np.fromiter(map(len, data), np.int64, len(data))
    at = np.r_[0, np.cumsum(size)]
    joined = np.frombuffer(b"".join(data), np.uint8)
    out = {}
    for name, members in CLASSES.items():
        table = np.zeros(256, bool)
        table[members] = True
        total = np.r_[0, np.cumsum(table[joined], dtype=np.int64)]
        out[name] = total[at[1:]] - total[at[:-1]]
    return out


def repeat_words(words: list[bytes], width: int = 5) -> int:
    """Words inside a `width`-word window that the text holds twice or more, the first one included."""
    grams = list(zip(*[words[i:] for i in range(width)], strict=False))
    if len(set(grams)) == len(grams):
        return 0
    count = Counter(grams)
    hit = np.fromiter((count[g] > 1 for g in grams), bool, len(grams))
    cover = np.zeros(len(words) + 1, np.int64)
    cover[np.flatnonzero(hit)] += 1
    np.subtract.at(cover, np.flatnonzero(hit) + width, 1)
    return int((np.cumsum(cover)[:-1] > 0).sum())


def stats(texts: list[str]) -> dict[str, np.ndarray]:
    """FEATURES and COUNTS of each text; an empty text has zeros."""
    data = [t.encode("utf-8", "surrogatepass") for t in texts]
    of = class_counts(data)
    per = np.zeros((len(data), 6), np.float64)
    for i, b in enumerate(data):
        words = b.split()
        if not words:
            continue
        lines = [x for x in b.split(b"\n") if x and not x.isspace()]
        seen = Counter(words)
        per[i] = len(words), len(seen), max(seen.values()), len(lines) - len(set(lines)), repeat_words(words), max(map(len, seen))
    n, char = per[:, 0], np.maximum(of["char"], 1)
    nz = np.maximum(n, 1)
    letters = of["upper"] + of["lower"]
    out = {
        "log_words": np.log1p(n), "word_len": (of["char"] - of["space"]) / nz, "upper_share": of["upper"] / np.maximum(letters, 1), "lower_share": of["lower"] / char,
        "digit_share": of["digit"] / char, "symbol_share": of["symbol"] / char, "bang_share": of["bang"] / char, "stop_share": of["stop"] / nz, "pipe_share": of["pipe"] / char,
        "other_share": (of["char"] - letters - of["digit"] - of["space"] - of["symbol"] - of["bang"] - of["stop"]) / char,
        "line_words": n / (of["line"] + 1), "distinct_words": per[:, 1] / nz, "top_word": per[:, 2] / nz, "dup_lines": per[:, 3] / (of["line"] + 1), "repeat_words": per[:, 4] / nz, "longest_word": per[:, 5],
    }
    return out | {"n_words": n.astype(np.int64), "word_chars": of["char"] - of["space"], "n_symbols": of["symbol"], "n_dup_lines": per[:, 3].astype(np.int64), "n_repeat_words": per[:, 4].astype(np.int64)}


SCHEMA = ", ".join([*(f"{x} double" for x in FEATURES), *(f"{x} long" for x in COUNTS)])


def with_stats(docs: DataFrame) -> DataFrame:
    """doc_id, FEATURES, COUNTS of every row; null texts count as empty."""

    def run(part: pa.RecordBatch) -> dict:
        return stats(texts_of(part)) | {"doc_id": part.column(0)}

    return per_slice(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, f"doc_id long, {SCHEMA}")
