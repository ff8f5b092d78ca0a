"""Array files read by many tasks: same records as a whole-file parse, and the same refusals."""

import json
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from civicflow.sources.landing import read_landing
from civicflow.sources.split_arrays import split_array_records


@pytest.fixture()
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "16k", "spark.sql.files.openCostInBytes": "1k"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k in keys:
        spark.conf.unset(k)


def _write(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def _records(n):
    rng = random.Random(1)
    tricky = ["a}b", '{"', 'x\\"y', "}}{{", "\\", '"', "é{", "", "[1,2],{", "日本}", "\n", '\\\\"}']
    return [{"unique_key": str(i), "t": rng.choice(tricky), rng.choice(tricky): None, "n": {"o": {"p": [i, {"q": "}"}]}}} for i in range(n)]


def test_one_file_spans_tasks(small_splits, tmpdir_path):
    recs = _records(2000)
    a = _write(tmpdir_path, "a.json", "﻿\n [ " + " , \n".join(json.dumps(r) for r in recs) + " ] \n")
    b = _write(tmpdir_path, "b.json", " [] ")
    c = _write(tmpdir_path, "c.json", json.dumps(recs[:3], ensure_ascii=False))
    rows = split_array_records(small_splits, [a, b, c]).select("file", F.to_json("raw_data").alias("j")).collect()
    spelled = lambda rs: sorted(json.dumps(r, sort_keys=True) for r in rs)
    of = lambda x: spelled([json.loads(r.j) for r in rows if r.file.endswith(x)])
    assert of("a.json") == spelled(recs) and of("b.json") == [] and of("c.json") == spelled(recs[:3])
    cut = small_splits.read.text(a, lineSep="}")
    assert cut.rdd.getNumPartitions() > 5  # many tasks read the one file


@pytest.mark.parametrize("text", ['[{"a":1} {"b":2}]', '[{"a":1},]', '[{"a":1}', '{"a":1}]', '[{"a":1}]x', '[{"a":1}}]', '[{"a":1},,{"b":2}]', '[{"a":"x}]',
                                  'x[{"a":1}]', '[{"a":1}},{"b":1}]', '{"a":1}', '[{"a":1}]{"b":2}', '[1]', '[{"a":}]'])
def test_malformed_files_are_refused(spark, tmpdir_path, text):
    with pytest.raises(Exception, match="malformed|MALFORMED|INVALID_JSON|JsonParse"):
        split_array_records(spark, [_write(tmpdir_path, "bad.json", text)]).select(F.to_json("raw_data")).collect()


def test_landing_cuts_large_files_only(spark, tmpdir_path):
    os.makedirs(os.path.join(tmpdir_path, "day"))
    _write(tmpdir_path, "day/large.json", json.dumps(_records(50)))
    _write(tmpdir_path, "small.json", json.dumps(_records(3)))
    _write(tmpdir_path, "one.json", '{"unique_key": "x"}')
    _write(tmpdir_path, "blank.json", "\t\n﻿")
    whole = read_landing(spark, tmpdir_path).select("filename", F.to_json("raw_data").alias("j"))
    cut = read_landing(spark, tmpdir_path, split_bytes=1000).select("filename", F.to_json("raw_data").alias("j"))
    rows = sorted(map(tuple, whole.collect()))
    assert rows == sorted(map(tuple, cut.collect())) and len(rows) == 54
    assert {r[0] for r in rows} == {"day/large.json", "small.json", "one.json"}


def test_a_files_text_does_not_meet_in_one_task(small_splits, tmpdir_path):
    """Without a small enough side by size, too: one file's pieces stay spread over its splits."""
    recs = _records(2000)
    path = _write(tmpdir_path, "a.json", "[" + ",".join(json.dumps(r) for r in recs) + "]")
    small_splits.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = split_array_records(small_splits, [path])
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert df.count() == 2000
    finally:
        small_splits.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not [ln for ln in plan.splitlines() if re.search(r"(SortMerge|ShuffledHash)Join \[file#\d+\], \[file#\d+\]", ln)], plan
