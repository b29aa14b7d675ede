from __future__ import annotations

from weftline import checkpoints


def filled(spark) -> int:
    """What the driver's heap takes after 500 MB of garbage."""
    jvm = spark.sparkContext._jvm
    for buffer in [jvm.java.nio.ByteBuffer.allocate(50_000_000) for _ in range(10)]:
        spark.sparkContext._gateway.detach(buffer)
    return jvm.java.lang.Runtime.getRuntime().totalMemory()


def test_a_grown_heap_is_given_back(spark, monkeypatch):
    runtime = spark.sparkContext._jvm.java.lang.Runtime.getRuntime()
    before = filled(spark)
    monkeypatch.setattr(checkpoints, "GROWN", 0.5 * before / runtime.maxMemory())
    monkeypatch.setattr(checkpoints, "_left", 0)
    assert checkpoints.checkpoint(spark.range(3)).count() == 3
    assert runtime.totalMemory() - runtime.freeMemory() < before - 400_000_000
    assert checkpoints._left == runtime.totalMemory()


def test_a_heap_that_cannot_shrink_is_left_alone(spark, monkeypatch):
    runtime = spark.sparkContext._jvm.java.lang.Runtime.getRuntime()
    monkeypatch.setattr(checkpoints, "GROWN", 0.0)
    monkeypatch.setattr(checkpoints, "_left", left := runtime.totalMemory())
    checkpoints.give_back(spark)
    assert checkpoints._left == left


def test_checkpoints_trim_the_native_heap(spark, monkeypatch):
    said, trim = [], checkpoints.trim
    monkeypatch.setattr(checkpoints, "trim", lambda session: said.append(trim(session)))
    assert checkpoints.checkpoint(spark.range(3)).count() == 3
    assert len(said) == 1 and "rim" in said[0]
