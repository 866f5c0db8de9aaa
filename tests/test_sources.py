"""CSV hand-off files: typed read with reject split."""

from restock.sources.csv import read_recommendations


def test_wrong_number_of_fields_is_rejected(spark, tmp_path):
    p = tmp_path / "recs.csv"
    p.write_text("APPROVE,1,East,F001,7-F001,10,0.5\nAPPROVE,2,East,F001,7-F001,10,0.5,more\nAPPROVE,3,East\n")
    ok, bad = read_recommendations(spark, str(p))
    assert [r.item_id for r in ok.collect()] == ["1"]
    assert sorted((r.item_id, r.reject_reason) for r in bad.collect()) == [("2", "wrong number of fields"), ("3", "wrong number of fields")]


def test_recommendation_csv_rejects(spark, tmp_path):
    p = tmp_path / "recs.csv"
    p.write_text(
        "APPROVE,123,East,F001,7-F001,10,0.5\n"
        "REJECT: Did not Propose,124,East,F001,7-F001,3,0.1\n"     # action wider than 10
        "APPROVE,125,East,F001,7-F001,ten,0.5\n"                    # bad integer
        "APPROVE,126,East,F001,,,\n")                               # empty fields are null, accepted
    ok, bad = read_recommendations(spark, str(p))
    assert sorted(r.item_id for r in ok.collect()) == ["123", "126"]
    reasons = {r.item_id: r.reject_reason for r in bad.collect()}
    assert "longer than 10" in reasons["124"]
    assert "proposed_qty" in reasons["125"]
    assert dict(ok.dtypes)["proposed_qty"] == "int"
