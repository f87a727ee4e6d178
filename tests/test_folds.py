from gavelframe.operators import folds


def turns(*texts):
    return [{"idx": i, "text": t} for i, t in enumerate(texts)]


def test_phases_go_forward_only():
    got = [r["phase"] for r in folds.phases(turns("hello", "come to order", "let us pray", "motion to approve", "call the roll", "come to order", "we are adjourned", "let us pray"))]
    assert got == ["PRE_GAVEL", "CALL_TO_ORDER", "INVOCATION", "MOTION_SEQUENCE", "ROLL_CALL", "INVOCATION", "ADJOURNMENT", "ADJOURNMENT"]
    assert [r["phase"] for r in folds.phases(turns("one two three four five six seven eight nine ten eleven", None))] == ["CALL_TO_ORDER"] * 2


def test_speakers():
    got = list(folds.speakers(turns("x come to order", "let us pray", "please call the roll Smith Yes Please No", "call the roll Smith", "so moved", "state your name", "thank you Ann", "my name is Ann Lee", "Jones makes the motion")))
    assert [(r["role"], r["name"], r["confidence"]) for r in got] == [("CHAIR", "CHAIR_INCUMBENT", 0.95), ("CHAIR/CLERGY", "INVOCATION_SPEAKER", 0.7), ("CLERK", "CLERK_INCUMBENT", 0.7), ("MEMBER", "Smith", 0.9), ("MEMBER", "MEMBER_PROCEDURAL", 0.7), ("CITIZEN", "PUBLIC_COMMENTER", 0.7), ("CHAIR", "CHAIR_INCUMBENT", 0.8), ("CITIZEN", "PUBLIC_COMMENTER", 0.7), ("CITIZEN", "PUBLIC_COMMENTER", 0.7)]
    assert got[-1]["members"] == ["Smith", "Jones"] and got[-1]["others"] == ["Ann Lee"]  # Please is no name


def test_quoted_sees_the_turn_before_as_resolved():
    rows = [{"text": "any comments from Baker?", "phase": "REPORTS", "role": "CHAIR", "name": "CHAIR_INCUMBENT", "confidence": 0.85}] + [{"text": x, "phase": "REPORTS", "role": "UNKNOWN", "name": "UNKNOWN", "confidence": 0.1} for x in ("yes I have", "a remark")] + [{"text": "Thank you alice", "phase": "REPORTS", "role": "CHAIR", "name": "CHAIR_INCUMBENT", "confidence": 0.8}]
    assert [(r["name"], r["confidence"], r["reason"]) for r in folds.quoted(rows)] == [("CHAIR_INCUMBENT", 0.85, None), ("Baker", 0.75, "chair_call_on"), ("alice", 0.85, "chair_acknowledgment"), ("CHAIR_INCUMBENT", 0.8, None)]


def test_squeeze_and_pack():
    assert folds.squeeze(["a b c", "b c d", "b c"]) == ["a b c d"]
    assert folds.squeeze(["Hello there.", "there friend", "new"]) == ["Hello there. friend", "new"]
    w = lambda n, end="": " ".join(["w"] * n) + end
    assert [len(x.split()) for x in folds.pack([w(3, "."), w(10, "."), w(5, "."), w(2)])] == [18, 2]
    assert all(len(x.split()) <= 60 for x in folds.pack([w(13)] * 20))
    assert folds.pack(["", " "]) == []


def test_figures():
    got = folds.figures("$1,200.50 is 12% of 10,004")
    assert [(k, r) for k, r, *_ in got] == [("CURRENCY", "$1,200.50"), ("PERCENT", "12%"), ("NUMBER", "10,004")]
    assert folds.figures(None) == []
    kinds = lambda x: [(k[0], r) for k, r, *_ in folds.figures(x)]
    assert kinds("-5 of +3.25 % and $ 7 in a1 2b 1,2345 $5% 1.") == [("N", "-5"), ("P", "+3.25 %"), ("C", "$ 7"), ("N", "1"), ("N", "2345"), ("C", "$5"), ("N", "1")]


def test_sentences():
    assert folds.sentences("okay dr lee said so please we agree Jones yes smith no thank you") == "Okay Dr lee said so please. We agree Jones yes. Smith no. Thank you"


def test_rows_of_words():
    word = lambda x, y, h=10: {"x": x, "y": y, "w": 8, "h": h}
    rows = folds.rows_of_words([word(50, 2), word(0, 0), word(0, 30), word(20, 33), word(90, 60)])
    assert [[(w["x"], w["y"]) for w in r] for r in rows] == [[(0, 0), (50, 2)], [(0, 30), (20, 33)], [(90, 60)]]


def test_small_folds():
    assert folds.distinct_recent(["a", "b", "a", "c", "d", "e", "f", "a"]) == ["a", "b", "c", "d", "e", "f", "a"]
    assert [r["turn_id"] for r in folds.repair_ids([{"turn_id": 5}, {"turn_id": None}, {"turn_id": 5}])] == [5, 2, 3]
    assert folds.running_mean_groups([1, 2, 3, 10], 1.5) == [[1, 2, 3], [10]]


def test_minutes_excerpts():
    import re

    from gavelframe.operators import lanes

    lines = ["II. Minutes", "approve the minutes of May", "", "", "motion by A", "III. Reports", "a motion here", "text", "more", "end"]
    fits = lambda p: re.compile(p).search
    got = lanes.minutes_excerpts([{"doc": 1, "line": x} for x in lines], fits("Minutes"), fits("motion"), fits("^[IVX]+[.]"))
    # the section ends at two blank lines, which go; the first motion is not covered, and its excerpt crosses the next heading
    assert [(g["kind"], g["start"], g["end"]) for g in got] == [("minutes_section", 1, 2), ("minutes_action", 4, 8), ("minutes_action", 6, 10)]
    assert got[0]["text"] == "II. Minutes\napprove the minutes of May" and lanes.minutes_excerpts([{"doc": 1, "line": None}], fits("x"), fits("x"), fits("x")) == []


def test_outline():
    from gavelframe.operators import lanes

    lines = ["I. CALL", "II.", "", "REPORTS: 1) first report", "a. Police", "i) no item", "II. again", "III. LAST", "2) item", "plain"]
    got = lanes.outline([{"doc": 1, "line": x} for x in lines])
    assert [(g["section"], g["title"], g["label"], g["item"]) for g in got] == [("I", "CALL", None, None), ("II", "REPORTS", None, None), ("II", None, "1", "first report"), ("II", None, "a", "Police"), ("III", "LAST", None, None), ("III", None, "2", "item")]


def test_recovered_modes():
    from gavelframe.operators import page_folds

    def page(mode, blank=False, **scores):
        return {"mode": mode, "blank": blank, **{k: 0.0 for k in ("m1", "m2", "a1", "a2", "c1", "c2", "att")}, **scores}

    modes = lambda *rows: [(r["mode"], r["recovered"]) for r in page_folds.recover_modes(list(rows))]
    u, one, two = page("unknown"), page("mode_1"), page("mode_2")
    assert modes(one, u, one) == [("mode_1", None), ("mode_1", "SANDWICH"), ("mode_1", None)]
    assert modes(two, two, page("unknown", c2=0.1))[-1] == ("mode_2", "CLUSTER_TAIL") and modes(two, two, u)[-1] == ("unknown", None)
    assert modes(page("unknown", m1=0.4, c1=0.4))[0] == ("mode_1", "LOW_CONFIDENCE")
    assert modes(one, u, page("unknown", blank=True), one)[1:3] == [("mode_1", "SHORT_GAP"), ("unknown", None)]
    assert modes(one, u, page("unknown", att=0.3), u, one)[1:4] == [("mode_1", "ATTACHMENT_CHAIN")] * 3
    assert modes(one, u, page("unknown", m2=0.6), u, one)[1:4] == [("unknown", None)] * 3
    assert modes(one, u, u, u, one)[1:4] == [("unknown", None)] * 3


def test_resolved_modes():
    from gavelframe.operators import page_folds

    def page(**scores):
        return {**{k: 0.0 for k in ("m1", "m2", "a1", "a2", "c1", "c2", "att")}, **scores}

    modes = lambda *rows: [(r["mode"], r["reason"]) for r in page_folds.resolve_modes(list(rows))]
    assert modes(page(a1=0.95), page(c1=0.3), page(c1=0.3, m2=0.6), page(c2=0.1)) == [("mode_1", "DIRECT_ANCHOR_M1"), ("mode_1", "CARRY_FORWARD"), ("mode_2", "COMPETITIVE_SWITCH"), ("unknown", "INSUFFICIENT_SIGNALS")]
    assert modes(page(m1=0.5), page(m1=0.9)) == [("mode_1", "LOOK_AHEAD"), ("mode_1", "DIRECT_SCORE")]
    assert modes(page(a1=0.95), page(att=0.4), page(m1=0.6, a1=0.4)) == [("mode_1", "DIRECT_ANCHOR_M1"), ("mode_1", "ATTACHMENT_CONTINUITY"), ("mode_1", "SEMANTIC_FALLBACK")]


def test_segments_absorb_blanks(spark):
    from gavelframe.operators import page_folds

    rows = [("u", False), ("u", False), ("m1", False), ("m1", False), ("m2", False), ("unknown", True), ("m2", False)]
    df = spark.createDataFrame([(1, i, label, blank, False) for i, (label, blank) in enumerate(rows)], "run int, page int, label string, blank boolean, fresh boolean")
    assert [r.segment for r in page_folds.absorbed(df).orderBy("page").collect()] == [1, 1, 2, 2, 3, 3, 3]
