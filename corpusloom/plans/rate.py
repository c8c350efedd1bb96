"""One budget of calls a second for all tasks of a stage.

The tasks of a barrier stage run at the same time and can tell each other something. At
the start of every period each says whether it still has calls to make; all compute the
same shares of the period's budget from the answers, and spread their own share over the
period. Tasks that are done get nothing, so that the others speed up, and stay until all
are done. As a period only starts when all tasks have waited the last one out, no period
sees more calls than its budget, whatever the tasks' clocks say.

Repeated tries of a call come out of the same budget: a provider calls `permit()` before
each but the first. Barrier stages need a free core for each task, and no dynamic
allocation; where that isn't so, tasks take equal shares of the rate each by itself.
"""

from __future__ import annotations

import threading
import time
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait

from pyspark import BarrierTaskContext, SparkContext


class Permits:
    """Calls that wait for their turn."""

    def __init__(self):
        self.waiting: deque[threading.Event] = deque()

    def take(self) -> None:
        turn = threading.Event()
        self.waiting.append(turn)
        turn.wait()

    def give(self) -> bool:
        """Lets the one that waits longest go; False if none waits."""
        try:
            self.waiting.popleft().set()
        except IndexError:
            return False
        return True


#: The permits of the stage that this worker process runs; none outside of one.
_permits: list[Permits] = []


def permit() -> None:
    """Waits until the rate of the stage allows one more try."""
    if _permits:
        _permits[-1].take()


def share(budget: int, busy: list[bool], me: int, turn: int) -> int:
    """How many of a period's calls are mine: equal parts, the rest by turns."""
    active = [i for i, b in enumerate(busy) if b]
    if me not in active:
        return 0
    each, over = divmod(budget, len(active))
    return each + ((active.index(me) - turn) % len(active) < over)


def one_budget(context: SparkContext, tasks: int) -> bool:
    """Whether a barrier stage of so many tasks can run."""
    return tasks <= context.defaultParallelism and context.getConf().get("spark.dynamicAllocation.enabled", "false") != "true"


def paced(rows: Iterator[dict], call: Callable[[dict], tuple], rate: float, threads: int, period: float, tasks: int, barrier: bool) -> Iterator[list[tuple]]:
    """call(row) of each row, at `rate` a second for all tasks together; results as they come.

    barrier: the stage is a barrier stage, and shares by need; else each of `tasks` tasks takes its equal part.
    """
    context = BarrierTaskContext.get() if barrier else None
    rate = rate if barrier else rate / tasks
    period = max(period, 1 / rate)
    permits, flying, turn = Permits(), set(), 0
    _permits.append(permits)
    following = next(rows, None)
    try:
        with ThreadPoolExecutor(threads) as pool:
            while True:
                busy = following is not None or bool(flying)
                said = [x == "1" for x in context.allGather(str(int(busy)))] if barrier else [busy]
                if not any(said):
                    return
                began = time.monotonic()
                mine = share(int(rate * period + 1e-9), said, context.partitionId() if barrier else 0, turn)
                for i in range(mine):
                    time.sleep(max(0.0, began + period * i / mine - time.monotonic()))
                    if following is None and not permits.waiting and not barrier:
                        break
                    if permits.give() or following is None or len(flying) >= threads:
                        flying, done = _landed(flying)
                        if done:
                            yield done
                        continue
                    flying.add(pool.submit(call, following))
                    following = next(rows, None)
                if following is None and not permits.waiting and flying and not barrier:
                    wait(flying, timeout=period, return_when=FIRST_COMPLETED)
                flying, done = _landed(flying)
                if done:
                    yield done
                if barrier or following is not None or permits.waiting:
                    time.sleep(max(0.0, began + period - time.monotonic()))
                turn += 1
    finally:
        _permits.remove(permits)


def _landed(flying: set[Future]) -> tuple[set[Future], list[tuple]]:
    done = {f for f in flying if f.done()}
    return flying - done, [f.result() for f in done]
