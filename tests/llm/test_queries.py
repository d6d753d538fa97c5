"""The registered queries: op1 against its SQL, and op2 from a folder in which workers cannot find the package."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import duckdb

from seriesloom.llm.queries import ORACLE, QUERIES

REPO = Path(__file__).resolve().parents[2]
SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
from seriesloom.llm.queries import QUERIES
spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", 4).config("spark.ui.enabled", "false").getOrCreate()
name = "op2_lm_scoring"
print(name, len(QUERIES[name](spark, {sf!r}).collect()))
"""


def test_op1_against_sql(spark, sf, tmp_path):
    given = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").limit(40).collect()]
    rows, new = list(given), 10**6
    for i, v in given[:12]:
        for shift in (0.0, 0.02, 0.05):  # copies, and chains of near ones
            rows.append((new := new + 1, [x + shift * (k % 3 - 1) for k, x in enumerate(v)]))
    odd = [None, [], [0.0] * 64, [float("nan")] + [1.0] * 63, [float("inf")] + [1.0] * 63, [None] + [1.0] * 63, [1.0, 2.0], [2.0, 4.0]]
    rows += [(new + 1 + k, v) for k, v in enumerate(odd)]
    path = str(tmp_path / "embeddings.parquet")
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(path)
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '{path}/*.parquet'")
    want = sorted(con.sql(ORACLE["op1_embedding_near_dedup"]).fetchall())
    found = QUERIES["op1_embedding_near_dedup"](spark, str(tmp_path))
    assert sorted(map(tuple, found.collect())) == want and sum(r[1] > 0 for r in want) >= 26


def test_workers_without_the_package(sf, tmp_path):
    (tmp_path / "run.py").write_text(SCRIPT.format(repo=str(REPO), sf=sf))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "run.py"], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]
    counts = dict(line.split() for line in done.stdout.splitlines() if line.startswith("op"))
    assert int(counts["op2_lm_scoring"]) > 0
