from datetime import datetime

from portpulse.operators import durations, outages

A = ("E", "P", "A")


def t(text):
    return f"2024-01-01 {text}"


def test_only_rows_strictly_inside_are_dropped(make_log, make_windows):
    times = ["00:59:59", "01:00:00", "01:00:00.000001", "01:59:59.999999", "02:00:00", "02:00:01"]
    log = make_log([(*A, "Available", t(x)) for x in times] + [("E", "Q", "B", "Charging", t("01:30:00"))])
    windows = make_windows([("A", t("01:00:00"), t("02:00:00"))])
    kept = outages.outside_outages(log, windows)
    mine = sorted(r.update_time for r in kept.where("cpo_name = 'A'").collect())
    assert mine == [datetime.fromisoformat(t(x)) for x in ("00:59:59", "01:00:00", "02:00:00", "02:00:01")]
    assert kept.where("cpo_name = 'B'").count() == 1


def test_overlapping_windows_do_not_multiply_rows(make_log, make_windows):
    log = make_log([(*A, "Available", t("01:30:00")), (*A, "Available", t("05:00:00"))])
    windows = make_windows([("A", t("01:00:00"), t("02:00:00")), ("A", t("01:10:00"), t("03:00:00"))])
    assert outages.outside_outages(log, windows).count() == 1


def test_window_over_midnight(make_log, make_windows):
    log = make_log([(*A, "Available", "2024-01-02 00:30:00")])
    windows = make_windows([("A", t("23:00:00"), "2024-01-03 01:00:00")])
    assert outages.outside_outages(log, windows).count() == 0


def test_open_window_lasts_to_the_end(make_windows):
    hi = datetime(2024, 1, 5)
    row = outages.closed_windows(make_windows([("A", t("01:00:00"), None)]), hi).first()
    assert row.online_timestamp == hi


def test_synthetic_rows_carry_the_last_known_status(make_log, make_windows):
    log = make_log(
        [
            (*A, "Charging", t("00:10:00")),
            (*A, "Reserved", t("01:30:00")),
            (*A, "Finishing", t("02:00:10")),
            (*A, "Available", t("02:00:50")),
            ("E", "late", "A", "Available", t("05:00:00")),
            ("F", "other", "B", "Available", t("05:00:00")),
        ]
    )
    windows = make_windows(
        [("A", t("01:00:00"), t("01:45:00")), ("A", t("01:50:00"), t("02:00:30"))]
    )
    rows = outages.with_outage_rows(log, windows)
    got = sorted(
        (r.evse_port_id, r.update_time.strftime("%H:%M:%S"), r.status or "")
        for r in rows.collect()
    )
    assert got == sorted(
        [
            ("P", "00:10:00", "Charging"),
            ("P", "01:00:00", "Missing"),
            ("P", "01:45:00", "Charging"),
            ("P", "01:50:00", "Missing"),
            ("P", "02:00:30", "Charging"),
            ("P", "02:00:50", "Available"),
            ("late", "01:00:00", "Missing"),
            ("late", "01:45:00", ""),
            ("late", "01:50:00", "Missing"),
            ("late", "02:00:30", ""),
            ("late", "05:00:00", "Available"),
            ("other", "05:00:00", "Available"),
        ]
    )


def test_status_before_online_in_its_own_minute(make_log, make_windows):
    log = make_log(
        [
            (*A, "Charging", t("02:00:05")),
            (*A, "Finishing", t("02:00:10")),
            (*A, "Available", t("02:00:50")),
        ]
    )
    windows = make_windows([("A", t("02:00:10"), t("02:00:30"))])
    rows = outages.with_outage_rows(log, windows).where("update_time = timestamp_ntz'2024-01-01 02:00:30'")
    assert [r.status for r in rows.collect()] == ["Finishing"]


def test_equal_windows_are_worked_on_once_and_give_their_rows_each(make_log, make_windows):
    log = make_log([(*A, "Charging", t("00:10:00")), (*A, "Available", t("03:00:00")), ("E", "Q", "A", "Reserved", t("00:20:00"))])
    windows = [("A", t("01:00:00"), t("02:00:00"))] * 3 + [("A", t("01:30:00"), t("02:00:00"))]
    counted = outages.counted_outage_rows(log, make_windows(windows))
    assert counted.count() == 3 + 2 * 2 * 2  # the log, and two rows for each port and different window
    rows = outages.with_outage_rows(log, make_windows(windows))
    assert rows.count() == 3 + 2 * 2 * 4
    back = sorted((r.evse_port_id, r.status) for r in rows.where("update_time = timestamp_ntz'2024-01-01 02:00:00'").collect())
    assert back == [("P", "Charging")] * 4 + [("Q", "Reserved")] * 4
    lo, hi = datetime(2024, 1, 1), datetime(2024, 1, 2)
    each = sorted(map(str, durations.all_amended_events(rows, lo, hi).collect()))
    assert each == sorted(map(str, durations.all_amended_events(counted, lo, hi).collect()))
