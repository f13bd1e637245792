"""Line-first quality rules.

Every line of a text is judged on its own: punctuation (does it end or hold a sentence, how many
symbols and repeated marks does it have), navigation (short items between separators, words of a
menu) and boilerplate (notices, lines that repeat an earlier line).  Lines that fail a rule are
removed, and a document that loses too much of its text is rejected.
"""

from __future__ import annotations

import re
from array import array
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geospan.llm.common import map_batches, slices

# The patterns are valid in Python and in RE2, so that SQL can apply the same ones to a line.
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
#: A line that ends a sentence, closing quotes and brackets aside, or has the end of one inside.
ENDS = r"""[.!?…:;।。！？]["'”’»)\]]*[\x20\x09-\x0D]*$"""
HOLDS = r"""[.!?…।]["'”’»)\]]*[\x20\x09-\x0D]|[。！？]"""
MARKS = r"[!?]{2,}"
#: A word of a line that only parts its items.
SEPARATOR = r"[|/»›•·→]+|::|>+"
#: Whole lines of menus.
MENU = (r"(?i)^[\x20\x09-\x0D]*(?:home(?: ?page)?|main menu|menu|site ?map|about(?: us)?|contact(?: us)?|log ?in|log ?out|"
        r"sign (?:in|up|out)|register|my account|search|next(?: page)?|previous(?: page)?|back to top|skip to (?:main )?content|"
        r"read more|show more|load more|see all|view all|share(?: this)?|follow us|subscribe|print|help|faq|"
        r"leave a (?:comment|reply)|related (?:posts|articles))[.!:»>…]*[\x20\x09-\x0D]*$")
#: Phrases of notices.
NOTICE = (r"(?i)all rights reserved|terms of (?:use|service)|privacy policy|cookie policy|use(?:s)? (?:of )?cookies|"
          r"accept (?:all )?cookies|enable javascript|powered by|click here|lorem ipsum|subscribe to our|"
          r"sign up for our|copyright (?:©|\(c\))|(?:©|\(c\)) ?(?:19|20)[0-9][0-9]")

_RULES = {k: re.compile(v) for k, v in (("word", WORD), ("symbol", SYMBOL), ("ends", ENDS), ("holds", HOLDS), ("marks", MARKS), (
    "separator", rf"(?:^|(?<=[\x20\x09-\x0D]))(?:{SEPARATOR})(?=[\x20\x09-\x0D]|$)"), ("menu", MENU), ("notice", NOTICE))}
#: Lines of more characters are read word by word, without a list of their words.
_LONG = 1 << 20
#: A notice in a longer line is a part of the text.
NOTICE_WORDS = 30


def line_fails(line: str, n_words: int, seen: bool) -> bool:
    """Whether a line of ``n_words`` words (one at least) breaks a rule.

    Punctuation: it neither ends a sentence nor holds the end of one; it has symbols, or runs of ! and
    ?, besides a first one, for more than a tenth of its words.  Navigation: two separators or more, with at most four
    words an item; a menu word.  Boilerplate: a notice in a line of at most 30 words; ``seen``, the line
    repeats an earlier one.
    """
    r = _RULES
    if seen or not (r["ends"].search(line) or r["holds"].search(line)):
        return True
    if 10 * (sum(map(line.count, "#*$%&|<>")) - 1) > n_words or 10 * (sum(1 for _ in r["marks"].finditer(line)) - 1) > n_words:
        return True
    parts = sum(1 for _ in r["separator"].finditer(line))
    if parts >= 2 and n_words - parts <= 4 * (parts + 1):
        return True
    return n_words <= NOTICE_WORDS and bool(r["menu"].search(line) or r["notice"].search(line))


def repeated_words(ids: np.ndarray, kinds: int) -> int:
    """Words inside three-word windows that occur twice or more; ids: the words as numbers under ``kinds``."""
    if len(ids) < 4:  # two windows need four words
        return 0
    if kinds < 2_000_000:  # its third power fits in a long
        key = (ids[:-2] * kinds + ids[1:-1]) * kinds + ids[2:]
    else:
        key = np.unique(ids[:-2] * kinds + ids[1:-1], return_inverse=True)[1] * kinds + ids[2:]
    order = np.argsort(key, kind="stable")
    equal = key[order[1:]] == key[order[:-1]]
    if not equal.any():
        return 0
    at = np.concatenate([order[1:][equal], order[:-1][equal]])
    covered = np.zeros(len(ids), bool)
    for k in range(3):
        covered[at + k] = True
    return int(covered.sum())


def judge(text: str, keep_text: bool = True) -> dict:
    """The counts of a text, and the text without the lines that fail."""
    word = _RULES["word"]
    number = defaultdict(count().__next__)
    ids = array("q")
    seen: set[str] = set()
    kept: list[str] = []
    lines = dup = failed = lost = chars = 0
    for line in text.split("\n"):
        before = len(ids)
        if len(line) < _LONG:
            ids.extend(map(number.__getitem__, word.findall(line)))
        else:
            ids.extend(number[m.group()] for m in word.finditer(line))
        n = len(ids) - before
        if n:
            size = len(line) - sum(map(line.count, " \t\n\v\f\r"))
            lines, chars = lines + 1, chars + size
            again = line in seen
            dup += again
            seen.add(line)
            if line_fails(line, n, again):
                failed, lost = failed + 1, lost + size
                continue
        if keep_text:
            kept.append(line)
    return {"n_words": len(ids), "word_chars": chars, "n_symbols": sum(map(text.count, "#*$%&|<>")), "n_dup_lines": dup,
            "n_repeat_words": repeated_words(np.frombuffer(ids, np.int64), len(number)) if ids else 0,
            "n_lines": lines, "n_failed_lines": failed, "lost_chars": lost, "cleaned": "\n".join(kept) if keep_text else None}


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = 50, most_repeated: int = 50,
          most_lost: int = 30, keep_text: bool = True) -> DataFrame:
    """(doc_id, cleaned, counts, base_failed, kept): one row for each row of ``docs``.

    cleaned is the whole text without the lines that fail (null with ``keep_text=False``); lines
    without a word stay and are no loss.  base_failed: under ``least_words`` words, or over
    ``most_repeated`` percent of them in three-word windows that occur twice or more.  kept: not
    base_failed, and at most ``most_lost`` percent of the characters of words are in lines that fail.
    A null text has no words (base_failed); rows without an id or that repeat one get rows of their
    own; other columns aren't read, so their names can't clash.  A task holds one text at a time.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_failed_lines", "lost_chars")

    def run(batches):
        for batch, texts in slices(batches, "text"):
            found = [judge(t, keep_text) for t in texts]
            yield {"doc_id": batch.column(0), "cleaned": pa.array([f["cleaned"] for f in found], pa.string()),
                   **{k: [f[k] for f in found] for k in counts}}
    found = map_batches(rows, run, "doc_id long, cleaned string, " + ", ".join(f"{k} long" for k in counts))
    base = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    return (found.withColumn("base_failed", base)
            .withColumn("kept", ~F.col("base_failed") & (100 * F.col("lost_chars") <= most_lost * F.col("word_chars"))))
