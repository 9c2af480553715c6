"""Small frames and the row-by-row answers the operators are compared with."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

T0 = datetime(2024, 1, 1)


def hours(n: float) -> datetime:
    return T0 + timedelta(hours=n)


def naive_asof(spine, features, ttl=None):
    """For each spine row (key, ts, ...): the winning feature row, found by a plain scan.

    Feature rows are (key, ets, created, value); keys are compared as SQL does.
    """
    out = []
    for row in spine:
        key, ts = row[0], row[1]
        best = None
        for f_key, ets, created, value in features:
            if key is None or f_key != key or ts is None or ets is None or ets > ts:
                continue
            if ttl and ets < ts - ttl:
                continue
            rank = (ets, created or datetime.min, value is not None, value or 0)
            if best is None or rank > best[0]:
                best = (rank, (ets, value))
        out.append((*row, *(best[1] if best else (None, None))))
    return out


def random_rows(seed: int, n_spine: int = 200, n_features: int = 300):
    """Few keys, few distinct times: many ties, null keys, null times and null values."""
    rnd = random.Random(seed)

    def key():
        return None if rnd.random() < 0.1 else rnd.choice([1, 1, 1, 2, 3, 4])

    def moment():
        return None if rnd.random() < 0.05 else hours(rnd.randrange(0, 60))

    spine = [(key(), moment(), i) for i in range(n_spine)]
    features = [
        (
            key(),
            moment(),
            hours(100 + rnd.randrange(0, 3)),
            None if rnd.random() < 0.2 else rnd.randrange(100),
        )
        for _ in range(n_features)
    ]
    return spine, features
