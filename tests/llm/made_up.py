"""Made-up texts and plain counterparts of what the operators do."""

from __future__ import annotations

import random
import re


def words(seed: int, n: int) -> list[str]:
    made = random.Random(seed)
    return ["".join(made.choices("abcdefgh", k=made.randint(2, 7))) for _ in range(n)]


def prose(seed: int, n: int = 60) -> str:
    return " ".join(words(seed, n))


def plain_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
