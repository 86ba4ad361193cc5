"""Commands over temporary files, end to end."""

import hashlib
import json

import pyarrow as pa

from tickloom import cli
from tickloom.sources import archive


def run(capsys, *argv):
    assert cli.main([str(a) for a in argv]) == 0
    return [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]


def test_lz4_frames(spark, tmp_path):
    with pa.CompressedOutputStream(pa.OSFile(str(tmp_path / "a.lz4"), "wb"), "lz4") as f:
        f.write(b"one\ntwo\nthree")
    (tmp_path / "b.lz4").write_bytes(b"")
    got = archive.lz4_lines(spark, str(tmp_path)).orderBy("ordinal").collect()
    assert [(r.ordinal, r.raw) for r in got] == [(0, "one"), (1, "two"), (2, "three")]


def test_order_flow_that_moves_the_mid_is_read_as_such(spark, tmp_path, capsys):
    """In each window the bid grows by a known size, and in the next one the mid rises in proportion."""
    def at(ms, bid_px, bid_sz):
        return json.dumps({"time": ms, "coin": "ETH", "levels": [[{"px": f"{bid_px:.2f}", "sz": f"{bid_sz}", "n": 1}], [{"px": f"{bid_px + 1:.2f}", "sz": "4", "n": 1}]]})

    lines, px, flows = [], 50.0, [1, 3, 2, 5, 2, 4, 1, 6, 3, 2] * 4
    for k, flow in enumerate(flows):
        lines += [at(10_000 * k + 2_000, px, 1), at(10_000 * k + 4_000, px, 1 + 1000 * flow)]
        px += 0.01 * flow
    (tmp_path / "book.jsonl").write_text("\n".join(["{", *lines, "[]"]))
    (row,) = (r for r in run(capsys, "ofi", tmp_path / "book.jsonl", "--windows", "10", "--horizons", "1") if r["horizon"] == "next(10s)")
    assert row["symbol"] == "ETH" and row["n"] == len(flows) - 2 and row["hac_lag"] == 1 and row["r"] > 0.99


def test_replay_with_and_without_snapshot(spark, tmp_path, capsys):
    new = lambda oid, side, px: {"oid": oid, "coin": "SOL", "side": side, "px": px, "raw_book_diff": {"new": {"sz": "2"}}}
    (tmp_path / "d").write_text("\n".join(json.dumps(x) for x in [{"time": 1, "height": 31, "data": {"book_diffs": [new(1, "B", "49.5"), new(2, "A", "50.5")]}}, {"time": 2, "height": 32, "data": {"book_diffs": [{**new(1, "B", "49.5"), "raw_book_diff": "remove"}]}}]))
    (row,) = run(capsys, "replay", tmp_path / "d")
    assert (row["A_px"], row.get("B_px"), row.get("anomalies"), row["stale"], row["checksum"]) == ("50.5", None, None, False, hashlib.sha256(b"coin=SOL;height=32;A|50.5|2:2;").hexdigest())
    (tmp_path / "s").write_text(json.dumps({"coin": "SOL", "time": 0, "height": 29, "bids": [{"oid": 9, "side": "B", "limit_px": "48.0", "sz": "1.0"}], "asks": []}))
    (row,) = run(capsys, "replay", tmp_path / "d", "--snapshot", tmp_path / "s")
    assert (row["B_px"], row["B_size"], row["stale"], row["anomalies"]) == ("48.0", 1.0, True, {"height_gap": 1})


def test_validate_gives_a_verdict(spark, tmp_path, capsys):
    new = lambda oid, coin, side, px: {"oid": oid, "coin": coin, "side": side, "px": px, "raw_book_diff": {"new": {"sz": "2"}}}
    block = lambda h, *events: json.dumps({"time": h, "height": h, "data": {"book_diffs": list(events)}})
    (tmp_path / "a").write_text("\n".join([block(1, new(1, "SOL", "B", "9"), new(2, "SOL", "A", "10")), block(2), block(3, {**new(7, "ETH", "B", "1"), "raw_book_diff": "remove"})]))
    (tmp_path / "b").write_text(block(5, new(3, "ETH", "B", "5.0"), new(4, "ETH", "A", "5")))
    sol, = run(capsys, "validate", tmp_path / "a", "--coins", "SOL")
    assert (sol["orders"], sol["bid"], sol["ask"], sol["sound"], sol["stale"], sol["anomalies"]) == (2, 9.0, 10.0, True, False, 0)
    assert cli.main(["validate", str(tmp_path / "a"), str(tmp_path / "b")]) == 1
    eth, sol = (json.loads(x) for x in capsys.readouterr().out.splitlines())
    assert (eth["crossed"], eth["stale"], eth["anomalies"], sol["sound"], sol["stale"]) == (True, True, 2, True, True)
    (tmp_path / "c").write_text(json.dumps({"time": 1, "height": 2, "data": {"book_diffs": [{**new(1, "SOL", "B", "1"), "memo": 1}]}}))
    assert cli.main(["validate", str(tmp_path / "c")]) == 1


def test_backtest_collect_and_settings(spark, tmp_path, capsys):
    (tmp_path / "p.csv").write_text("timestamp,open,high,low,close,volume\n" + "\n".join(f"2024-01-{d:02d} 00:00:00,1,1,1,{100 + d},1" for d in range(1, 20)))
    (row,) = run(capsys, "backtest", tmp_path / "p.csv", "--fee-bps", 0)
    assert abs(row["total_return"] - (119 / 101 - 1)) < 1e-9
    assert len(run(capsys, "collect", "BTC,ETH", "2024-01-01", "2024-01-02", "--types", "trades")) == 96
    assert {r["name"] for r in run(capsys, "settings")} == set(cli.SETTINGS)
