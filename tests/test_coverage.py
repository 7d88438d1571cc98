"""Every operator of the survey's inventory is claimed by at least one registered query."""

import re

from tidemark.plans.catalog import REGISTRY

SURVEY_IDS = ([f"S{i}" for i in range(1, 16)] + [f"P{i}" for i in range(1, 10)] + ["J1"]
              + [f"A{i}" for i in range(1, 4)] + [f"O{i}" for i in range(1, 9)] + [f"C{i}" for i in range(1, 5)]
              + ["N1", "N2"] + [f"E{i}" for i in range(1, 12)] + [f"B{i}" for i in range(1, 13)]
              + [f"SC{i}" for i in range(1, 4)] + [f"R{i}" for i in range(1, 9)] + [f"Q{i}" for i in range(1, 5)]
              + [f"D{i}" for i in range(1, 8)] + ["L1"])


def _expand(token: str) -> list[str]:
    m = re.fullmatch(r"([A-Z]+)(\d+)-(?:[A-Z]+)?(\d+)", token)
    if m:
        return [f"{m.group(1)}{i}" for i in range(int(m.group(2)), int(m.group(3)) + 1)]
    return [token] if re.fullmatch(r"[A-Z]+\d+", token) else []


def test_every_inventory_row_has_a_query():
    claimed = {i for q in REGISTRY.values() for tok in q.covers.split() for i in _expand(tok.strip("(),"))}
    assert [i for i in SURVEY_IDS if i not in claimed] == []


def test_every_query_has_an_oracle():
    assert all(q.oracle for q in REGISTRY.values())
