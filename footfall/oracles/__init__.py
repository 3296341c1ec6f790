"""The same steps as SQL for DuckDB, written separately from the plans, to check them against.

``STEPS`` maps a step name to a SELECT that may read other steps and the given tables;
``sql(step, columns)`` puts a step and all it needs into one statement.
"""

from __future__ import annotations

import re
from functools import cache

from footfall.oracles import inputs, keyword_steps, rec_steps, tag_steps
from footfall.oracles.expr import SAMPLE

STEPS: dict[str, str] = {
    **inputs.STEPS, **tag_steps.STEPS, **rec_steps.STEPS, **keyword_steps.STEPS,
}

_WORD = re.compile(r"[a-z_][a-z_0-9]*")


@cache
def _needs(step: str) -> tuple[str, ...]:
    words = dict.fromkeys(_WORD.findall(STEPS[step]))
    return tuple(w for w in words if w in STEPS and w != step)


def _ordered(step: str, seen: dict[str, None]) -> None:
    for need in _needs(step):
        if need not in seen:
            _ordered(need, seen)
    seen[step] = None


def sql(
    step: str, columns: list[str], sampled: bool = True, given: dict[str, str] | None = None
) -> str:
    """The statement for a step. ``sampled=False`` keeps every row where the step samples; ``given``
    replaces steps by other SELECTs, as for state that an earlier day left."""
    steps: dict[str, None] = {}
    _ordered(step, steps)
    text = {s: (given or {}).get(s, STEPS[s]).strip() for s in steps}
    ctes = ",\n".join(f"{s} AS MATERIALIZED (\n{text[s]}\n)" for s in steps)
    whole = f"WITH {ctes}\nSELECT {', '.join(columns)} FROM {step}"
    return whole if sampled else re.sub(r"> [0-9.]+ " + re.escape(SAMPLE), ">= 0", whole)
