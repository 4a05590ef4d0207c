"""Search over models that ends at a deadline."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool
from threading import Event

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

TRIED, STOPPED, NOT_TRIED = "tried", "stopped", "not tried"


def passes(estimator) -> int:
    """About how often a fit reads the rows: per level and round of trees, else per iteration."""
    has = {p.name: estimator.getOrDefault(p) for p in estimator.params if estimator.isDefined(p)}
    if "maxDepth" in has:
        return (has["maxDepth"] + 1) * has.get("maxIter", 1)
    return 1 if has.get("solver") == "normal" else has.get("maxIter", 1)


def search(
    candidates: Sequence[tuple[str, object]], train: DataFrame, judged: DataFrame, evaluator, seconds: float, parallelism: int = 2
) -> tuple[object | None, list[dict]]:
    """The best fitted model within ``seconds``, and a record per candidate in the order of trial.

    ``candidates`` are names and estimators; those with the fewest
    :func:`passes` go first, ties in the given order. A candidate is ``tried``
    when its error on ``judged`` is known, ``not tried`` when the time was over
    before its turn, and ``stopped`` when the deadline met it at work: its Spark
    jobs carry a tag and are cancelled by it, so one long fit does not hold the
    search, and other jobs of the session go on. A fit that fails by itself
    raises. ``train`` and ``judged`` are read by every fit and should be
    written tables. Ties go to the candidate tried first; without any error in
    time the best is None. Candidates and records are as few as the settings.
    """
    spark = train.sparkSession
    context, tag, over = spark.sparkContext, f"budget-{uuid.uuid4().hex[:12]}", Event()
    deadline = time.monotonic() + seconds
    better = 1 if evaluator.isLargerBetter() else -1
    order = sorted(candidates, key=lambda c: passes(c[1]))

    def trial(candidate):
        name, estimator = candidate
        record = {"candidate": name, "passes": passes(estimator), "status": NOT_TRIED, "error": None, "seconds": None}
        if over.is_set() or time.monotonic() >= deadline:
            return record, None
        start = time.monotonic()
        context.addJobTag(tag)
        try:
            model = estimator.fit(train)
            error = float(evaluator.evaluate(model.transform(judged)))
        except Exception:
            if not over.is_set():
                raise
            return {**record, "status": STOPPED, "seconds": time.monotonic() - start}, None
        finally:
            context.removeJobTag(tag)
        return {**record, "status": TRIED, "error": error, "seconds": time.monotonic() - start}, model

    with ThreadPool(parallelism) as pool:
        results = [pool.apply_async(inheritable_thread_target(spark)(trial), (c,)) for c in order]
        for result in results:
            result.wait(max(0.0, deadline - time.monotonic()))
        over.set()
        while not all(r.ready() for r in results):  # a fit may start its next job after one was cancelled
            context.cancelJobsWithTag(tag)
            time.sleep(0.1)
        done = [r.get() for r in results]
    fitted = [(better * r["error"], -i, m) for i, (r, m) in enumerate(done) if m is not None]
    best = max(fitted, key=lambda f: f[:2])[2] if fitted else None
    return best, [{"place": i, **r} for i, (r, _) in enumerate(done)]
