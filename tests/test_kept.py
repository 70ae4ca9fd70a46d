"""The kept ledger against upserts of the whole ledger; the kept inventory against fresh listings of real files."""

import os
import random

import pytest
from conftest import rows

from reelcat.operators.ledger import upsert_ledger
from reelcat.operators.media import latest_media
from reelcat.plans import kept_inventory as inv
from reelcat.plans import kept_ledger as led
from reelcat.sinks import kept
from reelcat.sources.files import read_inventory
from reelcat.streaming.ledger import STATUS_SCHEMA


def status(spark, data):
    return spark.createDataFrame(data, STATUS_SCHEMA)


def test_five_batches_equal_upserts_of_the_whole_ledger(spark, tmp_path):
    rng, base = random.Random(5), str(tmp_path / "ledger")

    def some(n, at):  # a third of all rows in one subject; repeated keys, null titles, null ids
        return [("@hot" if rng.random() < 0.34 else f"@s{rng.randrange(9)}", rng.choice([None, *[f"v{k}" for k in range(40)]]),
                 rng.choice([None, "", "t\n", f"t{k}"]), rng.random() < 0.5, at + k) for k in range(n)]

    whole = status(spark, some(200, 0))
    led.start_ledger(spark, base, whole, subjects=4)
    assert rows(led.kept_status(spark, base).select(*led.COLUMNS).fillna("~")) == rows(whole.fillna("~"))
    for number in range(1, 6):
        batch = status(spark, some(60, 1000 * number))
        whole = status(spark, [tuple(r) for r in upsert_ledger(whole, batch).collect()])
        led.merge_status(spark, base, batch, number)
        assert rows(led.kept_status(spark, base).select(*led.COLUMNS).fillna("~")) == rows(whole.fillna("~"))


def test_a_batch_of_one_subject_rewrites_its_cells_only_and_once(spark, tmp_path):
    base = str(tmp_path / "ledger")
    led.start_ledger(spark, base, status(spark, [(f"@s{s}", f"v{v}", "t", True, s * 100 + v) for s in range(30) for v in range(30)]), subjects=16)
    before = kept.current_version(spark, base).placed
    batch = status(spark, [("@s3", f"v{v}", "new", False, 9000 + v) for v in range(30)])
    done = led.merge_status(spark, base, batch, 7)
    after = kept.current_version(spark, base).placed
    moved = {c for c in after if after[c] != before.get(c)}
    assert 0 < done["cells"] == len(moved) <= led.PARTS < len(before)
    assert led.merge_status(spark, base, status(spark, [("@s3", "v1", "again", True, 1)]), 7)["cells"] == 0  # the number counts
    got = rows(led.kept_status(spark, base).where("NOT is_link_found").select("subject_name", "video_title").distinct())
    assert got == [("@s3", "new")]


def test_a_merge_that_fails_after_writing_changes_nothing(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "ledger")
    led.merge_status(spark, base, status(spark, [("@a", "v1", "t", True, 1)]), 1)
    commit = kept.commit_version
    monkeypatch.setattr(kept, "commit_version", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        led.merge_status(spark, base, status(spark, [("@a", "v1", "u", False, 2)]), 2)
    monkeypatch.setattr(kept, "commit_version", commit)
    assert rows(led.kept_status(spark, base), "video_title") == [("t",)]
    led.merge_status(spark, base, status(spark, [("@a", "v1", "u", False, 2)]), 2)
    assert rows(led.kept_status(spark, base), "video_title", "ledger_pos") == [("u", 1)]


def test_empty_ledger_and_empty_batch(spark, tmp_path):
    base = str(tmp_path / "ledger")
    assert led.kept_status(spark, base).count() == 0
    led.start_ledger(spark, base, status(spark, []))
    assert led.merge_status(spark, base, status(spark, []), 1) == {"cells": 0, "of": 0}
    assert led.kept_status(spark, base).count() == 0
    with pytest.raises(ValueError):
        led.start_ledger(spark, base, status(spark, []))


def put(base, name, text, time):
    path = base / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    os.utime(path, (time, time))


def listed(df):
    return rows(df.select(*inv.COLUMNS).fillna("~"))


def newest(df):
    return rows(df.select("subject_name", "quality_dir", "latest_file", "latest_mtime").fillna("~"))


def test_refreshes_find_what_changed_and_equal_a_fresh_listing(spark, tmp_path):
    media, base, rng = tmp_path / "media", str(tmp_path / "kept"), random.Random(3)
    names = [f"{s}/{q}{n}" for s in ("@hot", "@hot", "@a b", "@ü%+", "@n") for q in ("", "HighQuality/") for n in ("v1.mp4", "v 2.MP4", "x%20+.mp4", "no.txt")]
    (media / "@empty").mkdir(parents=True)
    for step in range(4):
        before = {r["path"]: (r["modification_time"], r["length"]) for r in inv.kept_files(spark, base).collect()}
        for name in rng.sample(names, 9):
            put(media, name, "x" * rng.randrange(9), 1_700_000_000 + rng.randrange(4))
        if step > 1:
            os.remove(next(p for p in sorted(media.rglob("*")) if p.is_file()))
        counts = inv.refresh_inventory(spark, str(media), base, folders=4)
        fresh = read_inventory(spark, str(media))
        now = {r["path"]: (r["modification_time"], r["length"]) for r in fresh.collect()}
        assert listed(inv.kept_files(spark, base)) == listed(fresh)
        assert newest(inv.kept_newest(spark, base)) == newest(latest_media(fresh))
        found = {(r["path"], r["change"]) for r in inv.inventory_changes(spark, base).where(f"refresh = {step + 1}").collect()}
        assert found == ({(p, "added") for p in now.keys() - before.keys()} | {(p, "removed") for p in before.keys() - now.keys()}
                         | {(p, "changed") for p in now.keys() & before.keys() if now[p] != before[p]})
        assert sum(counts[c] for c in ("added", "changed", "removed")) == len(found)


def test_one_changed_file_rewrites_one_cell_and_none_rewrites_none(spark, tmp_path):
    media, base = tmp_path / "media", str(tmp_path / "kept")
    for s in range(6):
        for n in range(6):
            put(media, f"@s{s}/v{n}.mp4", "x", 1_700_000_000 + n)
    assert inv.refresh_inventory(spark, str(media), base)["added"] == 36
    before = kept.current_version(spark, base).placed
    assert inv.refresh_inventory(spark, str(media), base) == {"added": 0, "changed": 0, "removed": 0, "cells": 0}
    assert kept.current_version(spark, base).placed == before
    put(media, "@s2/v0.mp4", "xy", 1_700_000_000)  # the length alone
    assert inv.refresh_inventory(spark, str(media), base) == {"added": 0, "changed": 1, "removed": 0, "cells": 1}
    after = kept.current_version(spark, base).placed
    assert sum(after[c] != before[c] for c in before) == 1


def test_an_emptied_base(spark, tmp_path):
    media, base = tmp_path / "media", str(tmp_path / "kept")
    put(media, "@a/v.mp4", "x", 1_700_000_000)
    inv.refresh_inventory(spark, str(media), base)
    os.remove(media / "@a" / "v.mp4")
    assert inv.refresh_inventory(spark, str(media), base)["removed"] == 1
    assert inv.kept_files(spark, base).count() == 0 and inv.kept_newest(spark, base).count() == 0
