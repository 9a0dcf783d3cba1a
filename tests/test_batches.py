"""Python functions over Arrow batches: what they hold follows a slice, not the batch that Spark sends."""
import os
import subprocess
import sys
import tracemalloc
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from webfold.functions.dom import main_content
from webfold.functions.markdown import markdown, walk
from webfold.operators.extract import extract_articles, main_markup
from webfold.operators.pages import to_markdown


def page(k, words=12):
    return f"<body><nav>menu</nav><article><p>page {k}</p><p>" + "<b>some</b> words of it " * words + "</p></article></body>"


CASES = {"main_markup": (lambda: main_markup(F.col("html")), 1, main_content), "markdown": (lambda: markdown(F.col("html"), F.col("url")), 2, walk)}


@pytest.fixture(params=CASES)
def step(request, spark, monkeypatch):
    """A step's function of batches, as Spark gets it, and the function of a row."""
    made, columns, of_row = CASES[request.param]
    found, udf = [], F.arrow_udf
    monkeypatch.setattr(F, "arrow_udf", lambda f, kind: found.append(f) or udf(f, kind))
    made()
    return (lambda batches: found[0](iter([b if columns == 2 else b[0] for b in batches]))), (lambda h, u: of_row(*(h, u)[:columns]))


def arrays(rows):
    return tuple(pa.array(list(c), pa.string()) for c in zip(*rows))


def test_a_batch_is_worked_in_slices(step):
    f, of_row = step
    rows = [(page(k), f"https://garden.test/{k}") for k in range(2500)]
    batch = arrays(rows)
    tracemalloc.start()
    sizes = [len(part) for part in f([batch])]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(sizes) == len(rows) and max(sizes) <= 1024
    assert peak < sum(a.nbytes for a in batch)
    assert [x for part in f([batch]) for x in part.to_pylist()] == [of_row(*r) for r in rows]


def test_large_pages_make_small_slices(step):
    f, _ = step
    batch = arrays([(page(k, 40_000), None) for k in range(12)])  # about 1 MB each
    sizes = [len(part) for part in f([batch])]
    assert sum(sizes) == 12 and max(sizes) <= 5


def test_nulls_and_batches_without_rows(step):
    f, of_row = step
    rows = [(None, None), (page(1), None), ("", "https://garden.test/"), (None, "x")]
    none = tuple(pa.array([], pa.string()) for _ in range(2))
    assert [x for part in f([none, arrays(rows), none]) for x in part.to_pylist()] == [of_row(*r) for r in rows]


def test_rows_keep_their_results_over_slices_and_batches(spark):
    """One partition of several batches of Spark's, each of several slices, with pages of mixed size and null ones."""
    n = 23_000
    html = F.when(F.col("page_id") % 7 == 3, F.lit(None)).otherwise(
        F.concat(F.lit("<article><p>page "), F.col("page_id").cast("string"), F.lit("</p><p>"), F.repeat(F.lit("words "), (F.col("page_id") % 50).cast("int")), F.lit("</p></article>")))
    pages = spark.range(0, n, 1, 1).select(F.col("id").alias("page_id"), F.lit("https://garden.test/x").alias("url")).withColumn("html", html)
    out = to_markdown(extract_articles(pages)).select("page_id", "text_content", "markdown")
    text = F.when(F.col("page_id") % 7 == 3, F.lit("")).otherwise(
        F.concat_ws("\n", F.concat(F.lit("page "), F.col("page_id").cast("string")), F.when(F.col("page_id") % 50 > 0, F.rtrim(F.repeat(F.lit("words "), (F.col("page_id") % 50).cast("int"))))))
    got = out.agg(F.count("*").alias("n"), F.count_if(F.col("text_content") == text).alias("texts"), F.count_if(F.replace("markdown", F.lit("\n\n"), F.lit("\n")) == text).alias("marks")).first()
    assert tuple(got) == (n, n, n)


UNEVEN = """
import re
import pyarrow as pa
from webfold.functions.batches import strings

def held():
    return int(re.search(r"Pss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())[1]) / 1024

def batch(n):  # rows of 1,000 bytes, as bytes of Python's, which is how a worker reads them
    offsets = pa.array(range(0, 1000 * n + 1, 1000), pa.int32()).buffers()[1]
    return (pa.Array.from_buffers(pa.string(), n, [None, offsets, pa.py_buffer(b"x" * (1000 * n))]),)

def batches():
    for n in (30_000, 28_000, 28_000, 1):
        yield batch(n)
        kept.append(bytes(100_000))  # what a task keeps between batches

list(strings(lambda x: x[:4], iter([batch(1)])))  # imports
kept, before = [], held()
for part in strings(lambda x: x[:4], batches()):
    last = held()
print(last - before)
"""


@pytest.mark.skipif(not os.path.exists("/proc/self/smaps_rollup"), reason="memory is read from Linux's /proc")
def test_batches_leave_no_gaps_in_memory():
    """In a process of its own: after batches of 30 and 28 MB, one of a row holds little more than itself."""
    run = subprocess.run([sys.executable, "-c", UNEVEN], cwd=Path(__file__).parents[1], capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    assert float(run.stdout) < 15, run.stdout
