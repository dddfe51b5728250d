"""Hand-written source files with the known defects, written to a folder."""

from __future__ import annotations

import csv
import json
from pathlib import Path

from strataline.sources.model import SOURCE_COLUMNS


def write_csv(path: Path, dataset: str, rows, header=None) -> None:
    """A file with the dataset's columns, or with those of ``header`` (others filled with x)."""
    path.parent.mkdir(parents=True, exist_ok=True)
    names = SOURCE_COLUMNS[dataset]
    with open(path, "w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(header or names)
        for row in rows:
            values = dict(zip(names, row))
            writer.writerow([values.get(c, "x") for c in header or names])


def write_json(path: Path, rows) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps([dict(zip(SOURCE_COLUMNS["school_events"], r)) for r in rows], indent=2))


REGIONS = ("Belconnen", "Woden")


def schools(n=4, closed=(), extra=()):
    out = [(f"SCH{i:03d}", f"School {i}", REGIONS[i % 2], "Primary", "1990-01-15",
            "Closed" if i in closed else "Active") for i in range(1, n + 1)]
    return out + list(extra)


def students(n=12):
    return [(f"STU{i:05d}", f"SCH{1 + i % 4:03d}", str(i % 13), ("Female", "Male")[i % 2], "2020-02-01",
             "Active") for i in range(n)]


def attendance(n=12, month="2024-02-01", start=0):
    return [(f"ATT{start + i:05d}", f"STU{i:05d}", f"SCH{1 + i % 4:03d}", month, "20", str(20 - i % 5),
             "Illness" if i % 5 else "") for i in range(n)]


def scores(n=12, year="2024", start=0):
    return [(f"ASM{start + i:05d}", f"STU{i:05d}", f"SCH{1 + i % 4:03d}", year,
             ("Reading", "Numeracy", "Writing")[i % 3], str(300 + 30 * i),
             "Low" if 300 + 30 * i < 400 else "Medium" if 300 + 30 * i < 550 else "High") for i in range(n)]


def events(n=3, day="2024-02-10"):
    return [(f"EVT{i:03d}", f"SCH{1 + i % 4:03d}", "Wellbeing program", day, "text") for i in range(n)]


def with_defects():
    """One batch with exactly the known defects: rules fail 1,1,1,4,1,0,1,0,0,0."""
    s = students() + [("STU_BAD_MISSING_SCHOOL", "", "3", "Male", "2020-02-01", "Active"),
                      ("", "SCH001", "3", "Male", "2020-02-01", "Active")]
    a = attendance()
    bad = list(a[0]); bad[0], bad[5] = "ATT90001", "25"
    copy = list(a[1]); copy[0] = "ATT90002"
    orphan = list(a[2]); orphan[0], orphan[1] = "ATT90003", "STU999999"
    g = scores()
    wrong = list(g[0]); wrong[0], wrong[5] = "ASM90001", "999"
    return {"schools": schools(), "students": s, "attendance": a + [bad, copy, orphan],
            "assessment_results": g + [wrong], "school_events": events()}


def write_batch(root: Path, batch_id: str, data) -> None:
    for dataset, rows in data.items():
        folder = root / dataset / f"batch_id={batch_id}"
        if dataset == "school_events":
            write_json(folder / "school_events.json", rows)
        else:
            write_csv(folder / f"{dataset}.csv", dataset, rows)


def write_month(root: Path, month: str, mode: str, data) -> None:
    suffix = "" if mode == "INITIAL_SNAPSHOT" else "_delta"
    folder = root / f"month={month}"
    names = {"schools": f"schools{suffix}.csv", "students": f"students{suffix}.csv",
             "attendance": "attendance.csv", "assessment_results": f"assessment_results{suffix}.csv"}
    for dataset, name in names.items():
        write_csv(folder / name, dataset, data.get(dataset, []))
    write_json(folder / "school_events.json", data.get("school_events", []))
    (folder / "_READY.json").write_text(json.dumps({
        "pipeline": "monthly", "reporting_month": month, "load_mode": mode,
        "expected_files": [*names.values(), "school_events.json"]}))
