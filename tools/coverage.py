"""Write COVERAGE.md: which queries check each inventory ID."""

from __future__ import annotations

import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from airq.plans import load_all  # noqa: E402
from airq.plans.registry import QUERIES  # noqa: E402

GROUPS = [("S", 16, "Sources and sinks"), ("F", 18, "Filters and projections"), ("E", 35, "Column expressions"), ("J", 25, "Joins"),
          ("A", 54, "Aggregations"), ("W", 17, "Windows"), ("K", 5, "Sort and top-k"), ("U", 4, "Set operations"), ("ST", 13, "Streaming"),
          ("M", 11, "Models")]
TESTED = {
    "ST9": "tests/test_tiers_alerts.py: late rows dropped after the watermark",
    "S15": "`m04_m07_forecast_and_hindcast` fits; `sources.sinks.save_model_variant` / `sources.readers.read_model_variant`",
}


def main() -> None:
    load_all()
    by_id: dict[str, list[str]] = {}
    for q in QUERIES.values():
        for i in q.ids.split():
            by_id.setdefault(i, []).append(f"`{q.name}`" + ("" if q.sql else " (rows)"))
    out = ["# Coverage", "", "Inventory ID, queries that check it (`(rows)` = no SQL twin), other tests.", ""]
    missing = []
    for p, n, title in GROUPS:
        out += [f"## {title}", "", "| ID | checked by |", "|---|---|"]
        for k in range(1, n + 1):
            i = f"{p}{k}"
            text = ", ".join(by_id.get(i, []) + ([TESTED[i]] if i in TESTED else []))
            missing += [] if text else [i]
            out.append(f"| {i} | {text or '—'} |")
        out.append("")
    (ROOT / "COVERAGE.md").write_text("\n".join(out))
    print(len(QUERIES), "queries,", sum(q.sql is not None for q in QUERIES.values()), "with SQL, missing:", missing)


if __name__ == "__main__":
    main()
