"""Fixtures and plain-Python counterparts for the tests of the subpackage."""

from __future__ import annotations

import random
import re
from collections import defaultdict

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = ("the of and to in that with from this have were said each which their time about many then them write would like "
         "these long make thing look more day could come did number sound most people over know water than call first").split()


def prose(rng: random.Random, n: int) -> str:
    out = []
    for i in range(n):
        word = rng.choice(WORDS) if rng.random() < 0.5 else "".join(rng.choices("abdeghilmnoprstu", k=rng.randint(3, 9)))
        out.append(word.capitalize() if i % 12 == 0 else word + ("." if i % 12 == 11 else ""))
    return " ".join(out)


def odd_texts() -> list[str | None]:
    """Texts that operators must stand."""
    return [None, "", " ", "\n\n", "a", "\t\x0b\x0c\r\n", "é", "😀 漢字 ﬁ", "word " * 3, "x" * 30_000, "same line\nsame line\nSAME LINE ",
            "tie", "tie", "\x00 nul", "a b c"]


def documents(spark, texts, clash: bool = False):
    """One row per text; `clash` adds columns named like results and internals."""
    rows = [(i, t, ("en", "de", None)[i % 3], f"src{i % 2}", None if t is None else len(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    if clash:
        for name in ("shard", "slot", "mark", "id", "line", "component", "prints", "fingerprint", "score", "bin_id", "spans",
                     "value", "at", "piece", "kept", "label", "start", "words", "toxic"):
            df = df.selectExpr("*", f"'clash' AS {name}")
    return df


class Union:
    def __init__(self, items):
        self.parent = {i: i for i in items}

    def find(self, i):
        while self.parent[i] != i:
            i = self.parent[i]
        return i

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def groups(self):
        out = defaultdict(list)
        for i in self.parent:
            out[self.find(i)].append(i)
        return out


def words_of(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
