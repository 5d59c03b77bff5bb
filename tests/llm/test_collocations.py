"""Phrase mining beside a plain count of all runs."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from concordat.llm import collocations
from concordat.llm.collocations import compact_paths, count_phrases, mine_phrases
from concordat.llm.common import table

UPPER = {ord("A") + i: ord("a") + i for i in range(26)}


def plain_counts(rows):
    counts = defaultdict(Counter)
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    counts[lang if lang is not None else "und"][tuple(words[i : i + k])] += 1
    return counts


def plain(rows, least=30, percent=80, top=2000):
    found = []
    for lang, count in plain_counts(rows).items():
        n = sum(c for g, c in count.items() if len(g) == 1)
        covered = {}
        for gram, c in count.items():
            if len(gram) > 2 and c >= least:
                for k in range(2, len(gram)):
                    for i in range(len(gram) - k + 1):
                        part = gram[i : i + k]
                        covered[part] = max(covered.get(part, 0), c)
        scored = []
        for gram, a in count.items():
            if len(gram) < 2 or a < least or 100 * covered.get(gram, 0) >= percent * a:
                continue
            cuts = []
            for k in range(1, len(gram)):
                l, r = count[gram[:k]], count[gram[k:]]
                cuts.append((2_000_000 * a // (l + r), k, l, r))
            score, _, l, r = min(cuts)
            scored.append((-score, -a, " ".join(gram).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(found)


def found(df):
    return sorted(map(tuple, df.collect()))


def odd_rows(seed):
    rng = random.Random(seed)
    words = ["the", "of", "New", "york", "é", "ÉÀ", "字", "|", "x\x00y", "ha", "in", "a\xa0b"]
    gaps = [" "] * 8 + ["  ", "\t", ", ", ".", "\n", " ; ", "\r\n", "\x0b"]

    def text(n):
        return "".join(rng.choice(words) + rng.choice(gaps) for _ in range(n))

    rows = [(text(rng.randint(0, 60)), rng.choice(["en", "fr", None, "und", ""])) for _ in range(150)]
    rows += [(None, "en"), ("", None), (" \t", "en"), ("...", "fr"), ("one", "de")]
    rows += [("ha " * 3000, "en"), ("ab ba " * 500, "en"), (text(4000), "fr"), ("x" * 9000, "en")]
    rows += [("a long passage that stands in very many texts without change at all", "en")] * 120
    return rows


@pytest.mark.parametrize("chunk, part", [(8 << 20, 6 << 20), (700, 3000)])
def test_equals_a_plain_count(spark, monkeypatch, chunk, part):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(collocations, "PART_BYTES", part)
    rows = odd_rows(chunk)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    docs = docs.select("*", F.lit(1).alias("n"), F.lit("x").alias("gram"), F.lit(2).alias("part"))
    expected = plain(rows, least=5, percent=80, top=40)
    assert found(mine_phrases(docs, least=5, percent=80, top=40)) == expected
    assert len(expected) > 60


def test_counts_follow_from_edges_and_ends(spark, monkeypatch):
    monkeypatch.setattr(collocations, "PART_BYTES", 2000)
    rows = odd_rows(9)
    docs = spark.createDataFrame(rows, "text string, lang string")
    got = {(r.lang, r.gram): r.n for r in count_phrases(docs, 1).where("words > 0").collect()}
    expected = {
        (lang, " ".join(g)): n for lang, count in plain_counts(rows).items() for g, n in count.items()
    }
    assert got == expected


def test_paths_are_unary_and_hold_every_node_once(spark, monkeypatch):
    monkeypatch.setattr(collocations, "PATH_CUT", 1 << 40)
    passage = [f"w{i}" for i in range(300)]
    rows = [(" ".join(passage), "en")] * 6 + [("w5 w6 w7 q", "en")] * 6 + [("a b " * 40, "en")] * 2
    docs = spark.createDataFrame(rows, "text string, lang string")
    grams = count_phrases(docs, 5)
    paths = [[at.node for at in row.nodes] for row in compact_paths(grams).collect()]
    nodes = [r.gram for r in grams.where("words = 3").collect()]
    assert sorted(node for path in paths for node in path) == sorted(nodes)
    # The passage forks once, after its sixth node; "a b a" and "b a b" form a circle.
    assert sorted(map(len, paths)) == [1, 1, 1, 6, 292]
    longest = max(paths, key=len)
    assert longest == [" ".join(passage[i : i + 3]) for i in range(6, 298)]


def test_no_texts(spark):
    docs = spark.createDataFrame([], "text string, lang string")
    assert mine_phrases(docs).collect() == []
    assert mine_phrases(spark.createDataFrame([(None, None)], "text string, lang string")).collect() == []


def test_whole_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = [(r.text, r.lang) for r in docs.collect()]
    assert found(mine_phrases(docs)) == plain(rows)
