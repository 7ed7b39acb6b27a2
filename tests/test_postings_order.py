"""Postings are compared by their terms first, as all of a task are in one bucket."""

import glob

import pyarrow.parquet as pq

from lexspark import build_index, table_chunks
from lexspark.plans import indexing


def test_postings_are_sorted_once_by_term(spark, tmp_path, monkeypatch):
    stored, keep = [], indexing.store

    def seen(df, path, by=()):
        if by:
            stored.append(df._jdf.queryExecution().toString().split("== Physical Plan ==")[1])
        return keep(df, path, by)

    monkeypatch.setattr(indexing, "store", seen)
    monkeypatch.setattr(indexing, "TASK_POSTINGS", 40)
    rows = [(i, " ".join(f"w{(i * j) % 23}" for j in range(1, 9))) for i in range(90)]
    documents = spark.createDataFrame(rows, "id long, text string")
    index = build_index(table_chunks(documents, "id", "text"), str(tmp_path), buckets=3)
    sorts = [x for x in stored[0].splitlines() if "Sort [" in x]
    assert sorts and all("Sort [term" in x for x in sorts)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    files = glob.glob(f"{tmp_path}/version-*/postings/bucket=*/*.parquet")
    found = [pq.ParquetFile(f).read(["term", "doc"]).to_pylist() for f in files]
    assert len(files) > 3 and all(f == sorted(f, key=lambda r: (r["term"], r["doc"])) for f in found)
    assert sum(map(len, found)) == index.postings.count()
