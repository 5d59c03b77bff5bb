"""Repeated runs of lines beside a table of all of them."""

import random

from concordat.llm.line_runs import drop_repeated_runs


def brute(docs, window=3):
    seen, found = {}, []
    for doc_id, text in sorted(set(docs), key=lambda d: (d[0] is not None, d[0] or 0, d[1] or "")):
        lines = (text or "").split("\n")
        gone = [False] * len(lines)
        for i in range(len(lines) - window + 1):
            run = tuple(lines[i : i + window])
            if run in seen:
                gone[i : i + window] = [True] * window
            seen.setdefault(run, doc_id)
        runs = sum(a and not b for a, b in zip(gone, [False, *gone]))
        kept = "\n".join(line for line, g in zip(lines, gone) if not g)
        found.append((doc_id, kept if text is not None else None, len(lines), sum(gone), runs))
    return found


def ours(df):
    return [(r.doc_id, r.text, r.n_lines, r.n_removed, r.n_runs) for r in drop_repeated_runs(df).collect()]


def test_random_lines(spark):
    rng = random.Random(2)
    lines = ["", "a", "b", "c", "ä\t", "a ", " long line " * 20]
    docs = [(i, "\n".join(rng.choices(lines, k=rng.randint(0, 12)))) for i in range(150)]
    docs += [(200 + i, docs[0][1] + "\n" + "\n".join(lines)) for i in range(60)]
    found = ours(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(found) == sorted(brute(docs))


def test_odd_rows(spark):
    body = "one\ntwo\nthree\nfour"
    rows = [
        (2, body, 1, "x"), (1, "zero\n" + body + "\nfive", 2, "y"), (3, None, 3, "z"), (4, "", 4, "w"),
        (2, body, 1, "x"), (None, body, 5, "v"), (5, body + "\r", None, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, body int, runs string")
    kept = drop_repeated_runs(docs)
    assert kept.columns == [*docs.columns, "n_lines", "n_removed", "n_runs"]
    found = {r.doc_id: (r.text, r.body, r.runs, r.n_removed) for r in kept.collect()}
    assert kept.count() == len(rows)
    assert found == {
        None: (body, 5, "v", 0), 1: ("zero\nfive", 2, "y", 4), 2: ("", 1, "x", 4), 3: (None, 3, "z", 0),
        4: ("", 4, "w", 0), 5: ("four\r", None, None, 3),
    }
    assert drop_repeated_runs(docs.limit(0)).collect() == []


def brute_words(docs, window=3, words=50):
    """As ``brute``, but runs of fewer lines with more than ``words`` words go too."""
    seen, found = set(), []
    for doc_id, text in sorted(set(docs)):
        lines = text.split("\n")
        gone = [False] * len(lines)
        for i in range(len(lines)):
            for size in range(1, min(window, len(lines) - i) + 1):
                run = tuple(lines[i : i + size])
                if size < window and len(" ".join(run).split()) <= words:
                    continue
                if run in seen:
                    gone[i : i + size] = [True] * size
                seen.add(run)
        runs = sum(a and not b for a, b in zip(gone, [False, *gone]))
        kept = "\n".join(line for line, g in zip(lines, gone) if not g)
        found.append((doc_id, kept, len(lines), sum(gone), runs))
    return found


def test_long_passages_on_few_lines(spark):
    passage = "word " * 51
    half = " ".join(["half"] * 26)
    docs = [(1, passage), (2, passage), (3, "x\n" + passage + "\ny"), (4, "w " * 50), (5, "w " * 50)]
    docs += [(6, f"{half}\n{half}"), (7, f"p\n{half}\n{half}\nq"), (8, f"{half}\nr\n{half}")]
    rng = random.Random(4)
    lines = ["", "a", passage, half, "b " * 30, "c\t" * 60]
    docs += [(10 + i, "\n".join(rng.choices(lines, k=rng.randint(1, 9)))) for i in range(120)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = drop_repeated_runs(frame, words=50).collect()
    found = [(r.doc_id, r.text, r.n_lines, r.n_removed, r.n_runs) for r in found]
    assert sorted(found) == sorted(brute_words(docs))
    removed = {row[0]: row[3] for row in found}
    assert [removed[d] for d in range(1, 9)] == [0, 1, 1, 0, 0, 0, 2, 0]
