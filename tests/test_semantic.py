"""Reply parsing, fallback placeholders, stub and rule providers."""

from cartograph import Options, discover_frames
from cartograph.operators import semantic as S
from cartograph import config as C

COLS = ["a", "b_c"]


def annotate_replies(spark, replies):
    cols = spark.createDataFrame([(0, 0, "a"), (0, 1, "b_c")], "dataset_id int, ordinal int, column_name string")
    out = {}
    for i, raw in enumerate(replies):
        rep = spark.createDataFrame([(0, "src", "t", raw, None)], S.REPLIES_SCHEMA)
        out[i] = S.annotations(rep, cols, Options()).orderBy("item_pos").collect()
    return out


def test_reply_shapes(spark):
    clean = '[{"column_name": "a", "business_label": "A", "description": "d", "sensitivity": "pii", "confidence": 0.9}]'
    replies = [
        clean,                                                         # 0 clean (b_c missing)
        "```json\n" + clean + "\n```",                                 # 1 fenced
        "Here you go: " + clean + " hope it helps",                    # 2 prose around
        '{"column_name": "a", "confidence": 0.9}',                     # 3 lone object
        "[1, 2, 3]",                                                   # 4 numbers
        '[{"column_name": "a"}]',                                      # 5 missing fields
        '[{"column_name": "zzz", "confidence": 0.7}]',                 # 6 unknown column
        '[{"column_name": "a", "confidence": "high"}]',                # 7 bad confidence
        'Note: [{"column_name": "a", "description": "x ] y", "confidence": 0.6}] end',  # 8
        "plain text",                                                  # 9
        "",                                                            # 10
        "x" * 3000,                                                    # 11
    ]
    out = annotate_replies(spark, replies)
    for i in (0, 1, 2):
        r = out[i]
        assert (r[0].column_name, r[0].sensitivity, r[0].confidence, r[0].status) == (
            "a", "pii", 0.9, "auto_accepted"), i
        assert r[1].column_name == "b_c" and r[1].description == C.FALLBACK_DESCRIPTION
    for i in (3, 4, 7, 9, 10, 11):
        assert [x.business_label for x in out[i]] == ["A", "B C"], i
        assert all(x.confidence == 0.3 and x.status == "low_confidence" for x in out[i]), i
    m = out[5][0]
    assert (m.business_label, m.description, m.sensitivity, m.confidence, m.status) == (
        "", "", "low", 0.5, "needs_review")
    assert [x.column_name for x in out[6]] == ["zzz", "a", "b_c"]
    assert out[8][0].description == "x ] y"           # widest [...] after the first fails
    assert len(out[11][0].raw_response) == 3000       # stored whole


def test_stub_and_rules(spark):
    df = spark.createDataFrame([(1, "x@example.org", 9.5)], "user_id long, email string, price double")
    from cartograph import Analysis
    a = Analysis(discover_frames(spark, {"t": df}, Options()), materialize=False)
    p = S.prompts(a.profiles).first().prompt
    assert p.startswith("Table name: t\n\nColumns (name | type | inferred_type | sample_values):\n")
    assert "  - email | StringType() | email | [x@example.org]" in p
    assert p.endswith("  - Total rows sampled: 1\n  - Null rates range: 0% – 0%")
    stub = S.annotate(a.profiles, Options(provider="stub")).collect()
    assert {r.status for r in stub} == {"low_confidence"}
    assert stub[0].raw_response == C.STUB_RESPONSE.format(n=len(p))
    rules = {r.column_name: r for r in S.annotate(a.profiles, Options(provider="rules")).collect()}
    assert rules["email"].sensitivity == "pii" and rules["price"].sensitivity == "high"


def test_callable_provider(spark):
    import pandas as pd
    df = spark.createDataFrame([(1, "x")], "id long, name string")
    from cartograph import Analysis
    a = Analysis(discover_frames(spark, {"t": df}, Options()), materialize=False)

    def model(pdf: pd.DataFrame) -> pd.DataFrame:
        assert (pdf["system_prompt"] == C.SYSTEM_PROMPT).all()
        return pd.DataFrame({"raw": ['[{"column_name": "id", "sensitivity": "medium", '
                                     '"confidence": 0.95}]'] * len(pdf)})

    rows = {r.column_name: r for r in S.annotate(a.profiles, Options(provider=model)).collect()}
    assert rows["id"].status == "auto_accepted" and rows["name"].confidence == 0.3


def test_failing_table_falls_back_alone(spark):
    import pandas as pd
    from cartograph import Analysis
    frames = {"good": spark.createDataFrame([(1,)], "id long"),
              "bad": spark.createDataFrame([(1,)], "x long")}
    a = Analysis(discover_frames(spark, frames, Options()), materialize=False)

    def model(pdf: pd.DataFrame) -> pd.DataFrame:
        if (pdf["table_name"] == "bad").any():
            raise RuntimeError("model down for this table")
        return pd.DataFrame({"raw": ['[{"column_name": "id", "confidence": 0.9}]'] * len(pdf)})

    rows = {r.table_name: r for r in S.annotate(a.profiles, Options(provider=model)).collect()}
    assert rows["good"].status == "auto_accepted" and rows["good"].from_reply
    assert rows["bad"].confidence == 0.3 and not rows["bad"].from_reply


def test_hanging_and_recovering_calls(spark, tmp_path):
    """A call without an end costs its table only; a second attempt may answer; waves lose nothing."""
    import time

    import pandas as pd
    from cartograph import Analysis
    frames = {f"t{k}": spark.createDataFrame([(k,)], "id long") for k in range(7)}
    a = Analysis(discover_frames(spark, frames, Options()), materialize=False)
    folder = str(tmp_path)

    def model(pdf: pd.DataFrame) -> list:
        import os
        name = pdf["table_name"].iloc[0]
        if name == "t1":
            time.sleep(600)
        if name == "t2" and not os.path.exists(f"{folder}/seen"):
            open(f"{folder}/seen", "w").close()
            raise RuntimeError("busy")
        return ['[{"column_name": "id", "confidence": 0.9}]']

    began = time.time()
    opts = Options(provider=model, model_timeout=1.0, model_attempts=2, model_tasks=2, model_wave=1)
    replies = S.ask(a.profiles, opts)
    assert time.time() - began < 120
    assert {(r.table_name, r.error) for r in S.failures(replies).collect()} == {("t1", "TimeoutError: no reply within 1 s")}
    rows = S.annotations(replies, a.profiles, opts).collect()
    assert len(rows) == 7 and sum(r.from_reply for r in rows) == 6
