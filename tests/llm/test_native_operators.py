"""Content sort, shards and url rules beside plain versions, on odd rows."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from concordat.llm import url_rules
from concordat.llm.common import table
from concordat.llm.content_sort import exact_duplicates
from concordat.llm.shards import assign_shards
from concordat.llm.url_rules import judge_urls


def plain_groups(docs):
    groups = defaultdict(list)
    for doc_id, text in docs:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((doc_id, len(text or "")))
    found = []
    for body, rows in groups.items():
        keep, size = min(rows, key=lambda r: (-r[1], r[0] is None, r[0] or 0))
        digest = hashlib.sha256(body.encode()).hexdigest()
        found += [(d, keep, len(rows), (d, n) == (keep, size), digest) for d, n in rows]
    return sorted(found, key=repr)


def test_content_sort(spark):
    rng = random.Random(1)
    bodies = ["", "same", "sa me", "\x0bsame\x0c", "é\xa0x", "éx", "long " * 3000, "long" * 3000]
    rows = [(i, rng.choice(bodies), "p", 1) for i in range(90)]
    rows += [(200 + i, "hot text", "p", 1) for i in range(300)] + [(None, "same", "", 2)]
    rows += [(201, "hot text", "p", 1), (500, None, None, None), (-3, "hot  text", "x", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part string, best int")
    found = sorted(map(tuple, exact_duplicates(docs).collect()), key=repr)
    assert found == plain_groups([row[:2] for row in rows])
    assert exact_duplicates(docs.limit(0)).collect() == []


def plain_shards(docs, shards):
    rows = [(d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in docs]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[1]))
    whole, before, found, slots = sum(r[1] for r in rows), 0, [], defaultdict(int)
    for doc_id, size, crc in rows:
        shard = min(shards - 1, (2 * before + size) * shards // (2 * whole))
        found.append((doc_id, size, crc, "bytes", shard, slots[shard], None))
        slots[shard] += 1
        before += size
    return found


def test_shards(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    found = sorted(map(tuple, assign_shards(docs, 24).collect()))
    assert found == sorted(plain_shards([(r.doc_id, r.text) for r in docs.collect()], 24))
    sizes = defaultdict(int)
    for row in found:
        sizes[row[4]] += row[1]
    mean = sum(sizes.values()) / 24
    assert max(abs(size - mean) for size in sizes.values()) <= max(row[1] for row in found)


def test_shards_of_odd_rows(spark):
    rows = [(2, None, 1), (None, "é", 2), (1, "x" * 5000, 3), (2, None, 1), (2, "b", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    found = sorted(map(tuple, assign_shards(docs, 5).collect()), key=repr)
    assert found == sorted(plain_shards([row[:2] for row in rows], 5), key=repr)
    assert assign_shards(docs.limit(0), 5).collect() == []


def plain_verdict(url, rules):
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = found.groups() if found else ("", "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule_host, rule_path, verdict in rules:
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
            rank = (len(rule_host) + len(rule_path), len(rule_host), verdict == "block")
            if best is None or rank > best[0]:
                best = rank, rule_host + rule_path, verdict
    return host, path, best and best[1], best[2] if best else "allow"


@pytest.mark.parametrize("seed", [1, 2])
def test_rules(spark, seed):
    rng = random.Random(seed)
    labels, steps = ["a", "b", "com", "net", "A", "", "ü"], ["", "/", "/x", "/x/", "/x/y", "/y", "?q", "#f"]

    def host():
        return ".".join(rng.choices(labels, k=rng.randint(1, 4)))

    def path():
        return "".join(rng.choices(steps[:6], k=rng.randint(0, 4)))

    rules = [(host().lower() or "a", path(), rng.choice(["allow", "block"])) for _ in range(60)]
    urls = [rng.choice(["http://", "x://", "", "://"]) + host() + "".join(rng.choices(steps, k=4)) for _ in range(400)]
    urls += [None, "", "no scheme", "http://a.com/x\ny://b", "http://" + "a." * 300 + "com/x/"] + ["http://hot.com/x"] * 300
    rows = [(n if n % 50 else None, url, "clash") for n, url in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string")
    table_ = spark.createDataFrame(rules, "host string, path string, verdict string")
    found = [tuple(row) for row in judge_urls(pages, table_).collect()]
    expected = [(page_id, *plain_verdict(url, rules)) for page_id, url, _ in rows]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert [tuple(r) for r in judge_urls(pages, none).collect()] == [(1, "a.com", "/", None, "allow")]
    some = spark.createDataFrame([("com", "/", "block")], none.schema)
    assert judge_urls(pages.limit(0), some).collect() == []
    assert url_rules.PARTS > 0
