"""Sample texts."""

from __future__ import annotations

import random

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lam mu nu xi omicron pi rho sigma tau ups".split()


def prose(seed: int, n: int) -> str:
    """Repeatable pseudo-random words."""
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", "a", "b", "c"]) + str(r.randint(0, 60)) for _ in range(n))
