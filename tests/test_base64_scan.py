"""Base64 decode against Python's, with ``=`` anywhere."""

import base64
import random

from pyspark.sql import functions as F

from tessera.functions.scalars import b64_decode, b64_length


def python_decode(text):
    try:
        return base64.b64decode(text)
    except ValueError:
        return None


def test_any_padding_equals_python(spark):
    rng = random.Random(3)
    texts = ["", "=", "==", "QUJD=QUJD", "QU==QUJD", "QUI=QUJD", "QU=JD", "Q=UJD", "=QUJD", "QUJD====", "Q", "Q===", "QU=\n=x",
             "QU=é=", "QUJDQ=====", "QU= =", "QUJ=D", "QUJ\x00=D=", "\n"]
    texts += ["".join(rng.choice("QUJDab=== \n-") for _ in range(rng.randrange(0, 24))) for _ in range(6000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", b64_decode("t").alias("d"), b64_length("t").alias("n")).collect()
    for r in rows:
        want = python_decode(r["t"])
        assert (None if r["d"] is None else bytes(r["d"])) == want, repr(r["t"])
        assert r["n"] == (None if want is None else len(want)), repr(r["t"])


def test_length_does_not_decode(spark):
    plan = spark.range(1).select(b64_length(F.lit("QUJD")).alias("n"))._jdf.queryExecution().analyzed().toString()
    assert "to_binary" not in plan and "unbase64" not in plan
