"""Labelled lines and the training of the rule list that quality.py applies.

Run ``python -m framemill.llm.training FOLDER`` to train on the documents of a
folder and print the rules for learned.py. At most MOST_DOCUMENTS documents (the
smallest by a hash of doc_id) are labelled; half of them, by hash, is held out.
The labels come from an annotation guide written for reading, not for speed; it
sees the text itself and the paragraph around a line, which the rules don't.
"""

from __future__ import annotations

import re

import numpy as np

from framemill.llm.quality import CLASSES, FEATURES, MARKER, common_list, lines
from framemill.llm.rules import apply, induce

#: Bound on the labelled sample.
MOST_DOCUMENTS = 30_000

_MARKUP = re.compile(r"&\w+;|&#\d+;|</?\w+/?>|%[0-9A-F]{2}|\\u[0-9a-f]{4}|\{\}|\(\);?")
_SUFFIX = re.compile(r"(, \w+)?(, \d+ mm)?[.;]?\s*$")


def annotate(texts: list[str], common: set[str]) -> list[str]:
    """The class of each line of one document, by the guide: look for junk first, then rows of cells, then entries; the rest is prose."""
    kinds = []
    cells = [max(len(re.findall(p, _MARKUP.sub("", t))) for p in (r"\|", r"\t", r"(?<!\));(?! )", r",(?! )", r"\S {2,}(?=\S)")) + 1 for t in texts]
    for i, t in enumerate(texts):
        words = re.findall(r"[^\W\d_]+", t.lower())
        tokens = t.lower().split()
        known = sum(w in common for w in words) / max(len(words), 1)
        marked = bool(re.match(MARKER, t))
        body = (re.sub(MARKER[:-2], "", t) if marked else t).replace(" ", "")
        near = [j for j in (i - 1, i + 1) if 0 <= j < len(texts)]
        beside = [texts[j] for j in near]
        row = cells[i] >= 3 and any(abs(cells[j] - cells[i]) <= 2 and cells[j] >= 3 for j in near) and not _MARKUP.search(t)
        strange = sum(ord(c) > 127 and not c.isalpha() or c in "ÃÂÐžŸœ€™¬¢" for c in body) / max(len(body), 1)
        signs = sum(not c.isalnum() for c in body) / max(len(body), 1)
        dump = sum(bool(re.fullmatch(r"[0-9a-f]{2,8}", w)) for w in tokens) >= 0.8 * len(tokens) and sum(bool(re.search("[a-f]", w) and re.search("[0-9]", w)) for w in tokens) >= 2
        code = len(tokens) == 1 and len(t) >= 8 and "_" not in t and (len(t) >= 40 or kinds[-1:] == ["junk"] and len(texts[i - 1]) >= 40 and " " not in texts[i - 1])
        if dump or code:
            kinds.append("junk")
        elif len(_MARKUP.findall(t)) * 4 > len(t) * 0.3 or strange > 0.12:
            kinds.append("junk")
        elif row and known < 0.2 and cells[i] < 40:
            kinds.append("table")
        elif signs > 0.4 and len(body) > 8 or len(set(body)) <= 3 and len(body) > 8:
            kinds.append("junk")
        elif len(tokens) >= 5 and len(set(tokens)) <= 0.35 * len(tokens) and (known < 0.15 or len(set(tokens)) <= 10):
            kinds.append("junk")
        elif not marked and len(set(tokens)) <= 3 and (t in beside and 2 <= len(tokens) != len(set(tokens)) or beside and all(b == t for b in beside)):
            kinds.append("junk")
        elif not marked and known < 0.13 and (max(map(len, tokens), default=0) >= 24 or len(t) >= 48 and ", " not in t or re.search(r"\b[0-9a-f]{4,8} [0-9a-f]{2,8}\b.*\d", t)):
            kinds.append("junk")
        elif cells[i] >= 3 and known < 0.2 and cells[i] < 40 or cells[i] == 2 and known < 0.2 and any(3 <= cells[j] < 40 for j in near) and not marked:
            kinds.append("table")
        else:
            core = re.findall(r"[^\W_]+", _SUFFIX.sub("", re.sub(MARKER[:-2], "", t)))
            entry_near = sum(bool(re.match(MARKER, b)) for b in beside)
            short_near = all(len(b) < 50 for b in beside) and bool(beside)
            if marked and (entry_near or len(core) <= 7):
                kinds.append("list")
            elif not marked and len(core) <= 6 and short_near and len(t) < 50 and not t.endswith((":", "!", "?")):
                kinds.append("list")
            else:
                kinds.append("prose")
    return kinds


def examples(documents, common: list[str]):
    """Names, features, labels, doc_ids, lengths and texts of the labelled lines."""
    from pyspark.sql import functions as F

    sample = documents.where("text is not null").orderBy(F.xxhash64("doc_id")).limit(MOST_DOCUMENTS)
    rows = lines(sample, common).orderBy("doc_id", "at").toPandas()
    y = np.array([k for _, g in rows.groupby("doc_id", sort=True) for k in annotate(g["line"].tolist(), set(common))], object)
    return list(FEATURES), rows[list(FEATURES)].to_numpy(float), y, rows["doc_id"].to_numpy(), rows["length"].to_numpy(), rows["line"].tolist()


def document_class(kinds: np.ndarray, lengths: np.ndarray) -> str:
    held = {k: lengths[kinds == k].sum() for k in CLASSES}
    return max(("table", "list", "junk"), key=lambda k: held[k]) if sum(held.values()) > 0.5 * lengths.sum() else "prose"


def train(names, x, y, ids, lengths, seeds=range(6)):
    """The rules, and on the held-out documents the shares of lines and of documents that get their label.

    Of the rule lists grown from several seeds, the one with the fewest errors on
    the training half is taken.
    """
    _, inverse, count = np.unique(ids, return_inverse=True, return_counts=True)
    ends = np.r_[0, np.cumsum(count)]
    spans = list(zip(ends[:-1], ends[1:]))
    held = np.array([hash((int(i), 7)) % 2 == 0 for i in ids])
    weights = 1 / np.sqrt(count[inverse])  # so that a few long lists do not decide
    truth = [document_class(y[a:b], lengths[a:b]) for a, b in spans]
    tried = []
    for seed in seeds:
        rules = induce(names, x[~held], y[~held], "prose", weights[~held], seed, order=("table", "junk", "list"))
        got = apply(rules, names, x, "prose")
        wrong = np.array([document_class(got[a:b], lengths[a:b]) != t for (a, b), t in zip(spans, truth)])
        out = held[ends[:-1]]
        tried.append((int(wrong[~out].sum()), float(weights[~held][got[~held] != y[~held]].sum()), seed, rules, float((got[held] == y[held]).mean()), float(1 - wrong[out].mean())))
    *_, rules, by_line, by_document = min(tried, key=lambda t: t[:3])
    return rules, by_line, by_document


def main(folder: str) -> None:
    from pyspark.sql import SparkSession

    from framemill.session import table

    spark = SparkSession.builder.getOrCreate()
    common = common_list(table(spark, folder, "common_words"))
    names, x, y, ids, lengths, _ = examples(table(spark, folder, "documents"), common)
    rules, by_line, by_document = train(names, x, y, ids, lengths)
    print("RULES = [")
    for r in rules:
        print(f"    {r!r},")
    print(f"]  # fmt: skip\n# held out: {by_line:.4f} of lines, {by_document:.4f} of documents")


if __name__ == "__main__":
    import sys

    main(sys.argv[1])
