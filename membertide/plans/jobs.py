"""Independent jobs at the same time."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

#: Jobs in flight at once. Small tables leave most cores idle; a large one fills them by itself.
AT_ONCE = 8


def together(spark: SparkSession, jobs: Iterable[Callable[[], object]], at_once: int = AT_ONCE) -> None:
    """Run jobs that write different tables; the first failure is raised once all have ended.

    Spark's scheduler shares the executors among them. With ``spark.scheduler.mode=FAIR`` they take
    turns; otherwise later ones fill what earlier ones leave.
    """
    with ThreadPoolExecutor(at_once) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    for job in running:
        job.result()
