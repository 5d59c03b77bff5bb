"""What the text operators leave on disk."""

import glob
import time

from concordat.llm.common import discard, staged
from concordat.llm.ngram_join import join_alike
from concordat.session import shared_folder


def _files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {block.toString() for block in _listed(spark, blocks.getAllBlocks())}


def _listed(spark, found):
    return [found.apply(i) for i in range(found.size())]


def test_shuffle_files_go_with_the_query_that_made_them(spark):
    before = _files(spark)
    rows = spark.range(1000).repartition(3, "id")
    kept = staged(rows, "test")
    for _ in range(50):  # they are deleted beside what follows
        left = _files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert kept.count() == 1000


def test_discarded_tables_are_gone(spark):
    kept = staged(spark.range(10), "test-gone")
    pattern = f"{shared_folder(spark)}/concordat/test-gone-*"
    assert len(glob.glob(pattern)) == 1
    discard(kept)
    assert not glob.glob(pattern)


def test_join_alike_keeps_no_table_it_has_done_with(spark):
    text = "one two three four five six seven eight nine ten eleven twelve"
    docs = spark.createDataFrame([(i, text if i % 2 else f"{text} {i}") for i in range(8)], "doc_id long, text string")
    folder = f"{shared_folder(spark)}/concordat"
    before = set(glob.glob(f"{folder}/*"))
    assert join_alike(docs).count() == 8
    left = {path.rsplit("/", 1)[1].split("-")[0] for path in set(glob.glob(f"{folder}/*")) - before}
    assert left <= {"described", "links"}
