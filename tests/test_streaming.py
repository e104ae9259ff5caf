"""The batch parser and report on a streaming file source."""

import tempfile

from tessera.operators import logs as L
from tessera.sources import textfiles
from tessera.sources.views import clf_lines_from
from tessera.streaming import stream_code_counts, stream_log_lines

from conftest import SF_SMALL


def test_stream_counts_equal_batch(spark):
    path = textfiles.write_lines(spark, clf_lines_from(spark, SF_SMALL), "stream-src")
    ckpt = tempfile.mkdtemp(prefix="tessera-stream-ckpt-")
    q = (stream_code_counts(stream_log_lines(spark, path)).writeStream
         .outputMode("complete").format("memory").queryName("code_counts")
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = {r["response_code"]: r["n"] for r in spark.sql("SELECT * FROM code_counts").collect()}
    want = {r["response_code"]: r["n"]
            for r in L.response_code_counts(L.load_logs(spark, SF_SMALL)).collect()}
    assert got == want
