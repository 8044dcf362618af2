"""The Markdown stream gives the same rows as the batch operator."""

import os
import tempfile

from pyspark.sql import functions as F

from quire.operators import markdown as MD
from quire.streaming import files as ST


def test_markdown_stream_matches_batch(spark):
    base = tempfile.mkdtemp(prefix="quire-stream-")
    src = os.path.join(base, "in")
    os.mkdir(src)
    texts = {"a.txt": "TITLE LINE\r\n\r\n1. Intro\n\nbody text", "b.txt": "Contents\n\nA .... 1\n\nB .... 2\n\nC .... 3\n\nend"}
    for name, t in texts.items():
        with open(os.path.join(src, name), "w", newline="") as f:
            f.write(t)
    q = ST.start_markdown_stream(spark, src, os.path.join(base, "out"), os.path.join(base, "ckpt"))
    q.awaitTermination(120)
    got = {r.name: r.md for r in spark.read.parquet(os.path.join(base, "out")).collect()}
    batch = spark.createDataFrame([(k, v.replace("\r\n", "\n")) for k, v in texts.items()], "name string, text string")
    exp = {r.name: r.md for r in MD.text_to_markdown(batch, "text", None, None).collect()}
    assert got == exp


def test_validation_stream(spark):
    base = tempfile.mkdtemp(prefix="quire-stream-")
    src = os.path.join(base, "in")
    os.mkdir(src)
    for name, t in {"ok.md": "# A\nx\n", "none.md": "no heading", "blank.md": "  \n"}.items():
        with open(os.path.join(src, name), "w") as f:
            f.write(t)
    q = (ST.validation_stream(ST.read_text_stream(spark, src))
         .writeStream.format("parquet").option("path", os.path.join(base, "out"))
         .option("checkpointLocation", os.path.join(base, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = {r.path.rsplit("/", 1)[1]: r.reason for r in spark.read.parquet(os.path.join(base, "out")).collect()}
    assert got["ok.md"] is None and got["blank.md"] == "document without text"
    assert got["none.md"]== "no line starts a chapter with '# '"
