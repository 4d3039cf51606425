"""Rule-based quality: repetition, symbols, and how a public vocabulary breaks the text up.

A vocabulary that was learned from ordinary text needs few tokens for ordinary text.  Junk needs many
tokens per character, falls back to bytes, or uses few different tokens.  For every text the tokens of
its words are counted, and three measures are held against bands that depend on its main script:
characters per token, share of byte-fallback tokens, and entropy of the token distribution.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from .text import BLANK, CONTINUES, Texts, WordStore, map_texts, repeats, slices

VOCABULARY = "piece_bpe_32k.model"
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

#: Scripts by the first byte of a character in UTF-8.
SCRIPTS = ("latin", "cyrillic", "greek", "hebrew_arabic", "indic", "cjk", "hangul", "other")
SCRIPT_OF = np.full(256, -1, np.int8)
SCRIPT_OF[65:91] = SCRIPT_OF[97:123] = SCRIPT_OF[0xC3:0xCA] = 0
SCRIPT_OF[0xD0:0xD4] = 1
SCRIPT_OF[0xCE:0xD0] = 2
SCRIPT_OF[0xD6:0xDC] = 3
SCRIPT_OF[0xE0] = 4
SCRIPT_OF[0xE3:0xEA] = 5
SCRIPT_OF[0xEA:0xEE] = 6
SCRIPT_OF[0xF0:0xF5] = 7


@dataclass(frozen=True)
class Band:
    """What a text may show; outside it is rejected."""

    chars_per_token: tuple[float, float]
    byte_share: float
    #: Bits per token; the bound falls with the number of tokens, as few tokens cannot have much entropy.
    entropy: float


#: By script; other scripts take the widest band.
BANDS: Mapping[str, Band] = {
    "latin": Band((1.6, 8.0), 0.10, 5.0),
    "cyrillic": Band((1.2, 8.0), 0.20, 5.0),
    "greek": Band((0.8, 6.0), 0.40, 4.5),
    "hebrew_arabic": Band((0.6, 6.0), 0.50, 4.0),
    "indic": Band((0.3, 6.0), 0.90, 4.0),
    "cjk": Band((0.3, 4.0), 0.90, 4.0),
    "hangul": Band((0.3, 4.0), 0.90, 4.0),
    "other": Band((0.2, 12.0), 1.00, 3.0),
}


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    #: Largest share of words in repeated 3-word windows, in percent.
    max_repeat_percent: int = 50
    #: Largest share of lines with a word that equal an earlier one.
    max_dup_lines: float = 0.3
    #: Largest number of symbols per word.
    max_symbols: float = 0.25
    bands: Mapping[str, Band] = field(default_factory=lambda: dict(BANDS))


SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, n_tokens long, chars_per_token double, byte_share double, token_entropy double, script string, reason string"
)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> tuple[WordStore, np.ndarray]:
    """Tokens by word, and which tokens are single bytes; one per worker process."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    is_byte = np.fromiter((model.is_byte(i) for i in range(model.vocab_size())), bool, model.vocab_size())
    return WordStore(lambda words: model.encode([w.decode("utf-8", "replace") for w in words], num_threads=1)), is_byte


def base_counts(read: Texts) -> dict[str, np.ndarray]:
    """Words, their characters, symbols, lines with a word, repeated ones and words in repeated 3-word windows, per text."""
    n = read.n
    start, end, doc = read.lines
    filled = np.searchsorted(read.word_start, end) > np.searchsorted(read.word_start, start)
    _, later = repeats(doc[filled], read.hashes(start[filled], end[filled]))
    windows, at = read.shingles(3)
    count, _ = repeats(read.word_doc[at], windows)
    marked = np.zeros(len(read.words) + 2, bool)
    for k in range(3):
        marked[at[count > 1] + k] = True
    return {
        "n_words": read.n_words,
        "word_chars": read.per_text(~(BLANK | CONTINUES)[read.data]),
        "n_symbols": read.per_text(SYMBOLS[read.data]),
        "n_lines": np.bincount(doc[filled], minlength=n),
        "n_dup_lines": np.bincount(doc[filled][later], minlength=n),
        "n_repeat_words": np.bincount(read.word_doc[marked[: len(read.words)]], minlength=n),
    }


def token_measures(read: Texts, store: WordStore, is_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: tokens, byte-fallback tokens, and bits of entropy per token."""
    tokens, sizes = store.lookup(read)
    doc = np.repeat(read.word_doc, sizes)
    n_tokens = np.bincount(doc, minlength=read.n)
    n_bytes = np.bincount(doc[is_byte[tokens]], minlength=read.n)
    keys = np.sort(doc * len(is_byte) + tokens)
    if not len(keys):
        return n_tokens, n_bytes, np.zeros(read.n)
    cut = np.flatnonzero(np.diff(keys, prepend=-1))
    counts = np.diff(np.append(cut, len(keys)))
    sums = np.bincount(keys[cut] // len(is_byte), counts * np.log2(counts), read.n)
    total = np.maximum(n_tokens, 1)
    return n_tokens, n_bytes, np.maximum(np.log2(total) - sums / total, 0)


def scripts(read: Texts) -> np.ndarray:
    """The script with most characters per text; ``other`` without any letter."""
    found = SCRIPT_OF[read.data]
    at = np.flatnonzero(found >= 0)
    doc = np.searchsorted(read.ends, at, side="right")
    counts = np.bincount(doc * len(SCRIPTS) + found[at], minlength=read.n * len(SCRIPTS)).reshape(read.n, -1)
    return np.where(counts.any(1), counts.argmax(1), len(SCRIPTS) - 1)


def verdicts(base: dict, n_tokens, n_bytes, entropy, script, rules: Rules) -> tuple[np.ndarray, list[str | None], np.ndarray, np.ndarray]:
    """``base_failed``, the first reason to reject (or None), characters per token and byte share."""
    words = base["n_words"]
    failed = (words < rules.min_words) | (100 * base["n_repeat_words"] > rules.max_repeat_percent * words)
    per_token = base["word_chars"] / np.maximum(n_tokens, 1)
    byte_share = n_bytes / np.maximum(n_tokens, 1)
    reasons = []
    for i in range(len(words)):
        band = rules.bands[SCRIPTS[script[i]]]
        # A text of n tokens has log2(n) bits at most; ordinary text has well over half of them.
        least = min(band.entropy, 0.55 * np.log2(max(n_tokens[i], 1)))
        reasons.append(
            "base" if failed[i]
            else "dup_lines" if base["n_dup_lines"][i] > rules.max_dup_lines * base["n_lines"][i]
            else "symbols" if base["n_symbols"][i] > rules.max_symbols * words[i]
            else "chars_per_token" if not band.chars_per_token[0] <= per_token[i] <= band.chars_per_token[1]
            else "byte_share" if byte_share[i] > band.byte_share
            else "entropy" if entropy[i] < least
            else None
        )
    return failed, reasons, per_token, byte_share


def measure(texts: list[bytes], path: str, rules: Rules = Rules()) -> dict[str, object]:
    """All columns but the id for some texts."""
    store, is_byte = vocabulary(path)
    read = Texts(texts)
    base = base_counts(read)
    n_tokens, n_bytes, entropy = token_measures(read, store, is_byte)
    script = scripts(read)
    failed, reasons, per_token, byte_share = verdicts(base, n_tokens, n_bytes, entropy, script, rules)
    del base["n_lines"]
    return base | {
        "base_failed": failed,
        "kept": [r is None for r in reasons],
        "n_tokens": n_tokens,
        "chars_per_token": per_token,
        "byte_share": byte_share,
        "token_entropy": entropy,
        "script": [SCRIPTS[s] for s in script],
        "reason": reasons,
    }


def rate_documents(docs: DataFrame, path: str | None = None, rules: Rules = Rules()) -> DataFrame:
    """One row per document with its counts, token measures and verdict.

    ``reason`` names the first rule that rejects, null for kept documents.  A null or empty text has no words and fails
    the base rule; a text without letters is judged by the band ``other``; repeated rows are judged each on their own; a
    null ``doc_id`` stays null; an empty table gives no row; other columns are not read.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches):
        for batch, texts in slices(batches):
            columns = measure(texts, path, rules)
            arrays = [batch.column("doc_id").cast(pa.int64()), *[pa.array(v) for k, v in columns.items() if k != "reason"]]
            arrays.append(pa.array(columns["reason"], pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *columns])

    return map_texts(docs, run, SCHEMA)


def keep_documents(docs: DataFrame, path: str | None = None, rules: Rules = Rules()) -> DataFrame:
    """The documents that no rule rejects, with all their columns, in one pass."""
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches):
        for batch, texts in slices(batches):
            yield batch.filter(pa.array(measure(texts, path, rules)["kept"], pa.bool_()))

    return map_texts(docs, run, docs.schema, tuple(docs.columns))
