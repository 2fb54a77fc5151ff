"""Map providers to firms: clean, match, derive crosswalks, consolidate."""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, as_completed
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

from idlink.operators.cascade import PROVIDERS, ProviderSpec, match_provider
from idlink.operators.crosswalk import consolidate, crosswalk
from idlink.operators.segments import Stage

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Source:
    """One provider to map: its spec, how to load its clean rows, and an on/off switch."""

    spec: ProviderSpec
    load: Callable[[], DataFrame]
    enabled: bool = True


@dataclass(frozen=True)
class Mapping:
    spec: ProviderSpec
    matches: DataFrame
    crosswalk: DataFrame


def map_provider(provider: DataFrame, master: DataFrame, spec: ProviderSpec, years: DataFrame | None = None) -> Mapping:
    matches = match_provider(provider, master, spec, years=years)
    return Mapping(spec, matches, crosswalk(matches, spec.entity))


def map_all(
    sources: list[Source], master: DataFrame, stage: Stage | None = None, at_once: int = 1, fail_fast: bool = False
) -> tuple[dict[str, Mapping], dict[str, Exception]]:
    """Map every enabled source; one that fails is reported and does not stop the others.

    Plans are lazy, so a failure while running is only caught here with a `stage` (see
    `sinks.stored`): it writes each provider's matches and crosswalk.

    `at_once` providers run at a time, each from a thread of its own and in a scheduler pool of its name,
    which shares the cluster fairly where `spark.scheduler.mode` is FAIR. Their jobs carry the tag `map-<name>`.
    With `fail_fast` the first failure cancels the jobs of the others, which then count as failed.
    """
    context = master.sparkSession.sparkContext
    enabled = [s for s in sources if s.enabled]
    done: dict[str, Mapping] = {}
    failed: dict[str, Exception] = {}
    stop = threading.Event()

    def mapped(source: Source) -> Mapping:
        if stop.is_set():
            raise RuntimeError("not started, as another provider failed")
        tag = job_tag(source.spec.name)
        context.setLocalProperty("spark.scheduler.pool", source.spec.name)
        context.addJobTag(tag)
        try:
            found = map_provider(source.load(), master, source.spec)
            if stage is None:
                return found
            matches = stage(found.matches)
            return Mapping(found.spec, matches, stage(crosswalk(matches, found.spec.entity)))
        finally:
            context.removeJobTag(tag)
            context.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max(1, at_once)) as pool:
        # Threads of their own have local properties of their own.
        running = {pool.submit(inheritable_thread_target(master.sparkSession)(mapped), source): source.spec.name for source in enabled}
        for future in as_completed(running):
            name = running[future]
            try:
                done[name] = future.result()
            except Exception as error:  # noqa: BLE001 - isolation is the point
                log.exception("provider %s failed", name)
                failed[name] = error
                if fail_fast and not stop.is_set():
                    stop.set()
                    for other in running.values():
                        context.cancelJobsWithTag(job_tag(other))
    order = [s.spec.name for s in enabled]
    return {n: done[n] for n in order if n in done}, {n: failed[n] for n in order if n in failed}


def job_tag(provider: str) -> str:
    return f"map-{provider}"


def consolidated(mappings: dict[str, Mapping]) -> DataFrame:
    """One table over this run's providers."""
    return consolidate({name: (m.crosswalk, m.spec.entity) for name, m in mappings.items()})


__all__ = ["PROVIDERS", "Mapping", "Source", "consolidated", "job_tag", "map_all", "map_provider"]
