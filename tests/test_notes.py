"""j4 lists every event that covers a day, not only what changed."""

from hydrolake.plans import telemetry


def test_notes_hold_every_covering_event(spark):
    open_, n = set(), 0
    rows = telemetry.j4_point_in_interval(spark, "/root/testdata/sf0.001").orderBy("station", "date").collect()
    for station in sorted({r.station for r in rows}):
        open_ = set()
        for r in (r for r in rows if r.station == station):
            parts = {c: [int(e) for e in r[c].split(",") if e] for c in ("opened", "closed", "note")}
            open_ = (open_ | set(parts["opened"])) - set(parts["closed"])
            assert parts["note"] == sorted(open_) and len(open_) == r.n_open
            n += len(open_)
    assert n > len(rows)
