"""Random change logs and an entity-by-entity model of what they mean."""

from __future__ import annotations

import datetime as dt
import random

LOG_SCHEMA = (
    "stream_id string, id string, change_type string, ts timestamp_ntz, seq bigint, note string, amount int"
)
START = dt.datetime(2024, 1, 1)


def random_log(seed: int, rows: int = 300, entities: int = 6, hot_share: float = 0.5) -> list[tuple]:
    """Changes in random order; entity 0 holds ``hot_share`` of them, with many equal times."""
    pick = random.Random(seed)
    out = []
    for seq in range(rows):
        entity = 0 if pick.random() < hot_share else pick.randrange(1, entities)
        kind = pick.choice(["Added", "Changed", "Changed", "Removed"])
        ts = START + dt.timedelta(minutes=pick.randrange(rows // 3))
        note = pick.choice([None, "a", "b"])
        out.append(("s%d" % (entity % 2), f"e{entity}", kind, ts, seq, note, pick.randrange(5)))
    pick.shuffle(out)
    return out


def histories(log: list[tuple]) -> dict[tuple, list[tuple]]:
    groups: dict[tuple, list[tuple]] = {}
    for row in log:
        groups.setdefault(row[:2], []).append(row)
    return {key: sorted(rows, key=lambda r: (r[3], r[4])) for key, rows in groups.items()}


def model_versions(log: list[tuple], soft: bool) -> tuple[list[tuple], list[tuple]]:
    """Apply the changes one by one: (versions, rejected changes)."""
    end = dt.datetime(9999, 12, 31)
    closed, refused = [], []
    for rows in histories(log).values():
        state = None
        for row in rows:
            if row[2] != "Removed":
                new = row
            elif soft and state is not None:
                new = (*row[:5], *state[5:])
            else:
                new = None
                if state is None:
                    refused.append(row)
            if state is not None:
                closed.append((*state[:3], state[3], row[3], *state[4:]))
            state = new
        if state is not None:
            closed.append((*state[:3], state[3], end, *state[4:]))
    return closed, refused
