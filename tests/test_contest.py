from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hustings.operators import rules, scoring
from hustings.plans.contest import Contest, admitted_entries, published, ranking

WORDS = "word " * 150


def utc(text):
    return datetime.fromisoformat(text)


def seats(frame, counts, status="declared"):
    rows = [(s, f"{s}{i}", "A", status) for s, n in counts.items() for i in range(n)]
    return frame(rows, "state string, constituency string, winner string, status string")


def picks(frame, correct, entry="e"):
    rows = [(entry, s, f"{s}{i}", "A" if i < right else "B") for s, (n, right) in correct.items() for i in range(n)]
    return frame(rows, "entry_id string, state string, constituency string, candidate string")


def score(frame, official, predictions, **options):
    counted = scoring.counted_seats(official)
    return scoring.entry_scores(scoring.state_accuracy(predictions, counted), counted, **options).collect()[0]


def test_accuracy_is_correct_over_counted(frame):
    got = scoring.state_accuracy(picks(frame, {"K": (140, 112)}), scoring.counted_seats(seats(frame, {"K": 140}))).collect()[0]
    assert (got.n_seats, got.n_correct, got.accuracy) == (140, 112, 0.8)


def test_mean_over_states_is_unweighted(frame):
    got = score(frame, seats(frame, {"K": 10, "L": 90}), picks(frame, {"K": (10, 10), "L": (90, 0)}))
    assert (got.aggregate, got.breadth, got.largest_accuracy) == (0.5, 1, 0.0)


def test_left_out_states_and_seats(frame):
    official = seats(frame, {"K": 10, "L": 90})
    assert score(frame, official, picks(frame, {"K": (5, 5)})).aggregate == 0.25
    assert score(frame, official, picks(frame, {"K": (5, 5)}), missing_as_zero=False).aggregate == 0.5


def test_uncounted_seats_leave_both_sides(frame):
    official = seats(frame, {"K": 10}).unionByName(seats(frame, {"L": 4}, "withheld"))
    official = official.withColumn("status", F.when(F.col("constituency") == "K0", "repoll").otherwise(F.col("status")))
    got = score(frame, official, picks(frame, {"K": (10, 10), "L": (4, 0)}))
    assert got.aggregate == 1.0
    listed = frame([("K", "K1")], "state string, constituency string")
    assert scoring.without_seats(official, listed).count() == 13


def test_latest_report_up_to_a_date_holds(frame):
    rows = [("K", "1", "A", "declared", 1), ("K", "1", "A", "disputed", 5), ("K", "2", "A", "withheld", 1), ("K", "2", "B", "declared", 2)]
    official = frame(rows, "state string, constituency string, winner string, status string, reported_at int")
    at = lambda day: {(r.constituency, r.winner) for r in scoring.counted_seats(official, F.lit(day)).collect()}
    assert at(3) == {("1", "A"), ("2", "B")} and at(9) == {("2", "B")}


BOARD = "entry_id string, aggregate double, submitted_at timestamp_ntz, breadth bigint, largest_accuracy double"


def test_tie_breaks_in_order(frame):
    early, late = utc("2026-04-18 15:00"), utc("2026-04-27 23:45")
    rows = [
        ("best", 0.9, late, 1, 0.1),
        ("b", 0.82, late, 5, 0.9), ("a", 0.82, early, 1, 0.1),
        ("four", 0.8, early, 4, 0.1), ("two", 0.8, early, 2, 0.9),
        ("wb84", 0.7, early, 3, 0.84), ("wb79", 0.7, early, 3, 0.79),
        ("same1", 0.5, early, 0, 0.5), ("same2", 0.5, early, 0, 0.5), ("last", 0.4, early, 0, 0.4),
    ]
    got = {r.entry_id: (r.rank, r.tied) for r in scoring.leaderboard(frame(rows, BOARD)).collect()}
    assert got == {
        "best": (1, 0), "a": (2, 0), "b": (3, 0), "four": (4, 0), "two": (5, 0), "wb84": (6, 0), "wb79": (7, 0),
        "same1": (8, 1), "same2": (8, 1), "last": (10, 0),
    }


def test_disqualified_entries_make_room_and_opt_outs_do_not(frame):
    day = utc("2026-04-18 15:00")
    scores = frame([("a", 0.9, day, 1, 0.1), ("b", 0.8, day, 1, 0.1), ("c", 0.7, day, 1, 0.1)], BOARD)
    listed = frame([("a",)], "entry_id string")
    moved = scoring.leaderboard(scoring.without_entries(scores, listed))
    assert {r.entry_id: r.rank for r in moved.collect()} == {"b": 1, "c": 2}
    hidden = scoring.without_entries(scoring.leaderboard(scores), listed)
    assert {r.entry_id: r.rank for r in hidden.collect()} == {"b": 2, "c": 3}
    assert {r.entry_id: r.prize for r in scoring.prizes(moved).collect()} == {"b": 100_000}


def test_tiers(frame):
    df = frame([(0.5999,), (0.6,), (0.7499,), (0.75,)], "x double").select(scoring.tier(F.col("x")))
    assert [r[0] for r in df.collect()] == ["none", "Tier 1", "Tier 1", "Tier 2"]


SUBMISSIONS = "submission_id int, entry_id string, submitted_at timestamp_ntz, has_predictions boolean, note_text string"


def last(frame, rows, schema=SUBMISSIONS):
    valid = rules.complete_submission(F.col("has_predictions"), F.col("note_text"))
    return {r.submission_id for r in rules.last_valid_submissions(frame(rows, schema), valid).collect()}


def test_the_fifth_of_six_counts(frame):
    rows = [(i, "e", utc(f"2026-04-0{i} 10:00"), True, WORDS) for i in range(1, 7)]
    assert last(frame, rows) == {5}


def test_the_period_is_local_time(frame):
    close = [(1, "e", utc("2026-04-30 18:29:59"), True, WORDS), (2, "e", utc("2026-04-30 18:30:00"), True, WORDS)]
    assert last(frame, close) == {1}
    opening = [(1, "e", utc("2026-03-23 18:29:59"), True, WORDS), (2, "f", utc("2026-03-23 18:30:00"), True, WORDS)]
    assert last(frame, opening) == {2}


def test_times_with_a_zone_do_not_depend_on_the_session(frame, spark):
    rows = [(1, "e", utc("2026-04-30 18:29:59+00:00"), True, WORDS), (2, "e", utc("2026-04-30 18:30:00+00:00"), True, WORDS)]
    schema = SUBMISSIONS.replace("timestamp_ntz", "timestamp")
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert last(frame, rows, schema) == {1}
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_invalid_submissions_do_not_count(frame):
    day = utc("2026-04-01 10:00")
    rows = [(1, "e", day, True, WORDS), (2, "e", day, True, "word " * 149), (3, "e", day, False, WORDS), (4, "f", day, True, None)]
    assert last(frame, rows) == {1}


def test_registrations(frame):
    rows = [("a", "p", 18, False, False), ("b", "q", 17, False, False), ("c", "r", 40, True, False), ("d", "s", 40, None, True), ("e", "p", 30, None, None)]
    df = frame(rows, "entry_id string, person_id string, age int, is_staff boolean, is_contesting boolean")
    assert {r.entry_id for r in rules.eligible(df).collect()} == {"a", "e"}
    assert [tuple(r) for r in rules.repeated_registrations(df).collect()] == [("p", 2)]


def test_teams(frame):
    rows = [("t1", p) for p in "abcde"] + [("t2", p) for p in "fghijk"] + [("t3", "x"), ("t4", "x"), ("t4", "y"), ("solo", "z"), ("solo", "z")]
    members = frame(rows, "entry_id string, person_id string")
    assert [tuple(r) for r in rules.roster_conflicts(members).collect()] == [("x", 2)]
    assert {(r.entry_id, r.n_members) for r in rules.valid_entries(members).collect()} == {("t1", 5), ("solo", 1)}


def test_late_team_changes(frame):
    rows = [("a", utc("2026-04-10 18:29:59"), False), ("b", utc("2026-04-10 18:30:00"), False), ("c", utc("2026-04-11 18:30:00"), True), ("d", utc("2026-04-12 00:00"), None), ("e", None, False)]
    df = frame(rows, "entry_id string, changed_at timestamp_ntz, notified boolean")
    assert {r.entry_id for r in rules.late_changes(df).collect()} == {"b", "d"}


def test_copies_are_paired_with_the_earliest_source_only(frame):
    def entry(name, day, k, l):
        return [(name, day, "K", f"K{i}", c) for i, c in enumerate(k)] + [(name, day, "L", f"L{i}", c) for i, c in enumerate(l)]

    rows = entry("a", 1, "ABAB", "AABB") + entry("b", 2, "ABAB", "AABB") + entry("c", 3, "ABAB", "BBBB") + entry("d", 4, "AAAA", "BBBA")
    df = frame(rows, "entry_id string, submitted_at int, state string, constituency string, candidate string")
    got = {(r.entry_id, r.source_entry): (r.shared_blocks, r.n_common, r.agreement) for r in rules.copied_submissions(df, ["state"]).collect()}
    assert got == {("b", "a"): (2, 8, 1.0), ("c", "a"): (1, 8, 0.75)}


def test_many_copies_give_few_pairs(frame):
    rows = [(f"e{n:03d}", n, "K", f"K{i}", "AB"[i % 2]) for n in range(60) for i in range(5)]
    df = frame(rows, "entry_id string, submitted_at int, state string, constituency string, candidate string")
    found = rules.copied_submissions(df, ["state"]).collect()
    assert len(found) == 59 and {r.source_entry for r in found} == {"e000"} and {r.agreement for r in found} == {1.0}


@pytest.fixture
def contest(frame):
    registrations = [
        ("good", "p1", 30, False, False, False), ("shy", "p2", 30, False, False, True), ("young", "p3", 15, False, False, False),
        ("twice1", "p4", 30, False, False, False), ("twice2", "p4", 30, False, False, False), ("moved", "p5", 30, False, False, False),
        ("cheat", "p6", 30, False, False, False), ("team", "p7", 30, False, False, False),
    ]
    members = [("moved", "p5", "E", "M", utc("2026-04-20 00:00"), False), ("team", "p7", "G", "Team", None, False), ("team", "p8", "H", "Team", None, False)]
    entries = [r[0] for r in registrations]
    submissions = [(i, e, utc(f"2026-04-1{i} 10:00"), True, WORDS) for i, e in enumerate(entries)]
    submissions.append((99, "good", utc("2026-04-25 10:00"), True, "too short"))
    right = {"good": 8, "shy": 10, "young": 10, "twice1": 10, "twice2": 10, "moved": 10, "cheat": 10, "team": 7}
    predictions = [(i, "K", f"K{s}", "A" if s < right[e] else "B") for i, e in enumerate(entries) for s in range(10)]
    predictions += [(99, "K", f"K{s}", "B") for s in range(10)]
    return Contest(
        registrations=frame(registrations, "entry_id string, person_id string, age int, is_staff boolean, is_contesting boolean, media_opt_out boolean"),
        members=frame(members, "entry_id string, person_id string, full_name string, team_name string, changed_at timestamp_ntz, notified boolean"),
        submissions=frame(submissions, SUBMISSIONS),
        predictions=frame(predictions, "submission_id int, state string, constituency string, candidate string"),
        official=seats(frame, {"K": 10}),
        disqualified=frame([("cheat",)], "entry_id string"),
    )


def test_whole_contest(contest):
    assert {r.entry_id for r in admitted_entries(contest).collect()} == {"good", "shy", "team"}
    board = ranking(contest)
    got = {r.entry_id: (r["rank"], r.aggregate, r.tier, r.prize) for r in board.collect()}
    assert got == {"shy": (1, 1.0, "Tier 2", 100_000), "good": (2, 0.8, "Tier 2", 10_000), "team": (3, 0.7, "Tier 1", None)}
    assert {r.entry_id: r["rank"] for r in published(contest, board).collect()} == {"good": 2, "team": 3}
    papers = scoring.certificates(board, contest.members).collect()
    assert {(r.full_name, r.team_name, r.aggregate, r.tier) for r in papers} == {("G", "Team", 0.7, "Tier 1"), ("H", "Team", 0.7, "Tier 1")}


def test_contest_from_tables_to_a_published_board(contest, spark, tmp_path):
    from dataclasses import fields

    from hustings.plans.contest import run

    for f in fields(contest):
        getattr(contest, f.name).write.parquet(f"{tmp_path}/{f.name}")
    board = run(spark, str(tmp_path), f"{tmp_path}/out").collect()
    assert [(r["rank"], r.entry_id) for r in board] == [(2, "good"), (3, "team")]
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2


def test_a_seat_counts_once_and_double_picks_are_wrong(frame):
    official = seats(frame, {"K": 2})
    rows = [("same", "K", "K0", "A")] * 3 + [("both", "K", f"K{i}", c) for i in range(2) for c in "AB"]
    rows += [("none", "K", "K0", None), ("away", "Z", "Z9", "A")]
    predictions = frame(rows, "entry_id string, state string, constituency string, candidate string")
    counted = scoring.counted_seats(official)
    got = {r.entry_id: (r.n_predicted, r.n_correct, r.accuracy) for r in scoring.state_accuracy(predictions, counted).collect()}
    assert got == {"same": (1, 1, 0.5), "both": (2, 0, 0.0), "none": (1, 0, 0.0)}
    everyone = frame([(e,) for e in ("same", "both", "none", "away")], "entry_id string")
    scores = scoring.with_absent(scoring.entry_scores(scoring.state_accuracy(predictions, counted), counted), everyone)
    assert {r.entry_id: r.aggregate for r in scores.collect()} == {"same": 0.5, "both": 0.0, "none": 0.0, "away": 0.0}


def test_missing_rank_keys_lose_nobody(frame):
    rows = [("a", 0.9, 1, 0, None), ("b", 0.9, 1, 0, None), ("c", 0.8, None, 0, 0.5), ("d", None, 1, None, 0.5)]
    scores = frame(rows, "entry_id string, aggregate double, submitted_at int, breadth int, largest_accuracy double")
    board = {r.entry_id: (r["rank"], r.tied) for r in scoring.leaderboard(scores).collect()}
    assert len(board) == 4 and board["a"] == board["b"] and board["a"][1] == 1


def test_a_seat_disputed_after_its_declaration_does_not_count(frame):
    rows = [("K", "P", "A", "declared", 1), ("K", "P", "A", "disputed", 2), ("K", "Q", "B", "declared", 1)]
    official = frame(rows, "state string, constituency string, winner string, status string, reported_at int")
    assert [r.constituency for r in scoring.counted_seats(official).collect()] == ["Q"]


def test_suspected_copies_of_the_submissions_that_count(contest, frame):
    from hustings.plans.contest import suspected_copies

    # Of the admitted entries "shy" has ten seats right, "good" eight and "team" seven.
    near = {(r.entry_id, r.source_entry, r.agreement, r.n_equal) for r in suspected_copies(contest, 80).collect()}
    submitted = {r.entry_id: r.submitted_at for r in contest.submissions.where("submission_id < 99").collect()}
    earlier = lambda a, b: (a, b) if submitted[a] > submitted[b] else (b, a)
    assert near == {(*earlier("good", "shy"), 0.8, None), (*earlier("good", "team"), 0.9, None)}
    same = contest.predictions.unionByName(contest.predictions.where("submission_id = 1").withColumn("submission_id", F.lit(7)))
    same = same.dropDuplicates()
    contest.predictions = contest.predictions.where("submission_id != 7").unionByName(same.where("submission_id = 7 and candidate = 'A'"))
    got = {(r.entry_id, r.source_entry): (r.agreement, r.n_equal) for r in suspected_copies(contest, 95).collect()}
    assert got == {("team", "shy"): (1.0, 2)}
