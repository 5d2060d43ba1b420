"""Line-first cleaning: rules are asked of every line, failing lines go, and a document that loses too much is rejected.

A line fails as (the first that holds names it)
  repeated     it equals an earlier line of the document;
  navigation   at least three separators stand between its words, one for every five words or more, or it is a few words
               that are all of a menu;
  symbols      at least three of # * $ % & | < >, and more than one for two words;
  stuttering   over a third of its words (eight or more) are the word before again;
  shouting     over four tenths of its characters are capitals (five words or more), or a fourth of its words end in !!;
  boilerplate  up to 30 words with a phrase of licences, notices or site furniture;
  punctuation  no mark that ends a sentence stands at the end of any of its words.
Lines without a word are neither kept nor lost. A document is rejected without looking at lines if it has under 20
words, or if over 30 of 100 words lie in 8-word windows that it holds twice; else if over 60 of 100 characters of
its words lie in failing lines.

Counts are sums over byte classes of a batch's text buffer, and windows are ranked by pairing ranks (1, 2, 4, 8 words),
so equal windows have equal numbers and none are told by a hash. Everything is per row: no shuffle.

Defined results: null text has no words (rejected, as under 20); repeated rows give equal rows; no rows give none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import map_rows, texts
from .words import numbered_words

WINDOW, FEWEST, MOST_REPEATED, MOST_LOST = 8, 20, 30, 60
RULES = ("repeated", "navigation", "symbols", "stuttering", "shouting", "boilerplate", "punctuation")

# Patterns are of RE2, as SQL's are.
SEPARATOR = r"(^|[\x20\x09-\x0D])([|»›•·>/~]|->|::)([\x20\x09-\x0D]|$)"
MENU = (
    r"(?i)^[^\p{L}]*(home|menu|login|log in|sign in|sign up|register|logout|search|next|previous|back|share|tweet|print|top|contact|contact us|about|about us|help|faq|site ?map|"
    r"read more|more|skip to content|skip to main content|close|subscribe|follow us|comments?|reply|toggle navigation)([^\p{L}]+(home|menu|login|search|next|previous|back|share|tweet|print|top|contact|about|help|faq|more|close|comments?|reply))*[^\p{L}]*$"
)
SENTENCE = r"[.!?…。！？؟।:;][\p{Pe}\p{Pf}\p{Po}\"']*([\x20\x09-\x0D]|$)"
BOILERPLATE = (
    r"(?i)(all rights reserved|licensed under|released under the|general public license|terms of (use|service)|privacy policy|cookie (policy|settings|notice)|(uses?|accept|enable) (all )?(cookies|javascript)|"
    r"copyright (©|\(c\)|[0-9]{4})|© ?[0-9]{4}|lorem ipsum|click here|subscribe to|sign up for|powered by|follow us on|share this|page not found|unsubscribe)"
)
CAPITAL = r"\p{Lu}"
LOUD = r"!!+([\x20\x09-\x0D]|$)"

SPACES, SYMBOLS, STARTS = np.zeros(256, bool), np.zeros(256, bool), np.ones(256, bool)
SPACES[[32, *range(9, 14)]] = True
SYMBOLS[list(b"#*$%&|<>")] = True
STARTS[128:192] = False  # bytes that go on with a character


def sums(marks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many marks lie between each two bounds."""
    upto = np.append(0, np.cumsum(marks, dtype=np.int64))
    return upto[bounds[1:]] - upto[bounds[:-1]]


def repeated_words(ids: np.ndarray, counts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Of each text, how many words lie in windows (a power of two words long) that occur twice or more in it."""
    n, ends = len(ids), np.cumsum(counts)
    text = np.repeat(np.arange(len(counts)), counts)
    if n < window:
        return np.zeros(len(counts), np.int64)
    rank, step = ids, 1
    while step < window:
        _, rank = np.unique(rank[:-step] * (int(rank.max()) + 1) + rank[step:], return_inverse=True)
        step *= 2
    begin = np.flatnonzero(np.arange(len(rank)) + window <= ends[text[: len(rank)]])
    _, same, often = np.unique(text[begin] * (int(rank.max()) + 1) + rank[begin], return_inverse=True, return_counts=True)
    begin = begin[often[same] > 1]
    edge = np.zeros(n + 1, np.int64)
    edge[begin] += 1
    edge[begin + window] -= 1
    return np.bincount(text[np.cumsum(edge[:n]) > 0], minlength=len(counts))


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, and where each string begins and the last one ends."""
    column = column.cast(pa.large_string())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    return data, bounds - bounds[0]


def lines_of(column: pa.Array, ids: np.ndarray) -> dict[str, np.ndarray | pa.Array]:
    """The lines of a batch of texts whose words have these numbers: text, place, counts, and the first rule that fails (or -1)."""
    split = pc.split_pattern(column.cast(pa.large_string()), "\n")
    lines, text = split.flatten(), pc.list_parent_indices(split).to_numpy()
    data, bounds = _bytes(lines)
    space = SPACES[data]
    head = ~space
    before = np.append(True, space[:-1])
    before[bounds[:-1][bounds[:-1] < len(data)]] = True
    words, chars = sums(head & before, bounds), sums(head & STARTS[data], bounds)
    some = words > 0
    code = lines.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    _, first = np.unique(text.astype(np.int64) * (code.max(initial=0) + 1) + code, return_index=True)
    again = np.ones(len(words), bool)
    again[first] = False
    marks = sums(SYMBOLS[data], bounds)
    ends = np.append(0, np.cumsum(words))  # the words of lines, one after the other, are the texts' words
    same = np.append(False, ids[1:] == ids[:-1])[: len(ids)]
    same[ends[:-1][some]] = False
    stutters = sums(same, ends)
    count = lambda pattern: pc.count_substring_regex(lines, pattern).to_numpy(zero_copy_only=False)
    holds = lambda pattern: pc.match_substring_regex(lines, pattern).to_numpy(zero_copy_only=False)
    between = count(SEPARATOR)
    fails = (
        again,
        (between >= 3) & (5 * between >= words) | holds(MENU),
        (marks >= 3) & (2 * marks > words),
        (words >= 8) & (3 * stutters > words),
        (words >= 5) & (10 * count(CAPITAL) > 4 * chars) | (words >= 5) & (4 * count(LOUD) >= words),
        (words <= 30) & holds(BOILERPLATE),
        ~holds(SENTENCE),
    )
    rule = np.full(len(words), -1)
    for i in reversed(range(len(fails))):
        rule[fails[i] & some] = i
    return {"lines": lines, "text": text, "chars": chars, "some": some, "again": again & some, "rule": rule}


def clean(docs: DataFrame, most_lost: int = MOST_LOST, tell: bool = True) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, lost_chars and a count of lines per rule; ``tell`` adds cleaned, the text of the lines left.

    ``docs``: doc_id, text and others, which are left out. Rejected documents stay as rows: filter by ``kept``.
    """
    doc_id = docs.schema["doc_id"].dataType.simpleString()

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            column, n = batch["text"], batch.num_rows
            _, ids, n_words = numbered_words(column.to_pylist())
            data, bounds = _bytes(column)
            each = lines_of(column, ids)
            per_text = lambda marks, weights=None: np.bincount(each["text"][marks], None if weights is None else weights[marks], minlength=n).astype(np.int64)
            repeated = repeated_words(ids, n_words)
            chars, failing = sums(~SPACES[data] & STARTS[data], bounds), each["rule"] >= 0
            lost = per_text(failing, each["chars"])
            base_failed = (n_words < FEWEST) | (100 * repeated > MOST_REPEATED * n_words)
            made = {"doc_id": batch["doc_id"], "n_words": n_words, "word_chars": chars, "n_symbols": sums(SYMBOLS[data], bounds), "n_dup_lines": per_text(each["again"]), "n_repeat_words": repeated}
            made |= {"base_failed": base_failed, "kept": ~base_failed & (100 * lost <= most_lost * chars), "lost_chars": lost}
            made |= {f"lines_{name}": per_text(each["rule"] == i) for i, name in enumerate(RULES)}
            if tell:
                left = each["some"] & ~failing
                stay, bound = each["lines"].filter(pa.array(left)).to_pylist(), np.searchsorted(each["text"][left], np.arange(n + 1))
                made["cleaned"] = ["\n".join(stay[a:b]) for a, b in zip(bound[:-1], bound[1:], strict=True)]
            return made

        return step

    schema = f"doc_id {doc_id}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, lost_chars long"
    return map_rows(texts(docs, "doc_id"), schema + "".join(f", lines_{name} long" for name in RULES) + ", cleaned string" * tell, make)
