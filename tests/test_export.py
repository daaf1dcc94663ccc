import json

import pytest

from brightledger.__main__ import main
from brightledger.sources import io
from tests.test_staging import award, frame

SUPPLIERS = ["ACME SECRET SUPPLY", "BRAVO HIDDEN TRADING", "CHARLIE PRIVATE ENTERPRISES"]
SEEDS = {
    "areas": "token,canonical,kind\nA,Alpha,province\nB,Beta,province\n",
    "analysis_amounts": "round_amount,amount_kind,note\n" + "".join(f"{g},{k},\n" for g, k in ((1_000_000, "threshold"), (2_000_000, "threshold"), (500_000, "placebo"), (300_000, "placebo"), (1_500_000, "placebo"))),
    "core_thresholds": "threshold,amount,effective_from,effective_to,applies_to,legal_basis,source\nsmall_purchase,1000000,2016-01-01,2025-02-24,a,b,c\nsmall_purchase,2000000,2025-02-25,,a,b,c\n",
    "large_amount_allowlist": "award_id,reviewed_on,evidence\n0118,2025-01-01,seen\n0119,2025-01-01,seen\n",
    "supplier_pair_labels": 'band,similarity,key_a,key_b,label,review_status\n0,0.85,"ACME, INC.",ACME,same,reviewed\n0,0.85,ACME,BRAVO,different,reviewed\n1,0.92,ACME,ACNE,unsure,reviewed\n',
}
DOCUMENTS = ["agencies", "agency_years", "bunching", "bunching_by_type", "cliff", "concentration", "focus_area", "patterns", "rule_change", "same_day", "summary", "yearly"]


def awards(n=120):
    import datetime as dt

    rows = [award(i, awardee_name=SUPPLIERS[i % 3], contract_amount=990_000.0 if i // 2 % 2 else 400_000.0, award_date=dt.datetime(2023 + i % 2, 3, 1), area_of_delivery="A") for i in range(n)]
    rows[118]["contract_amount"] = rows[119]["contract_amount"] = 2e10  # reviewed
    return rows


@pytest.fixture(scope="module")
def place(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("batch")
    (root / "raw").mkdir()
    (root / "seeds").mkdir()
    for name, text in SEEDS.items():
        (root / "seeds" / f"{name}.csv").write_text(text)
    frame(spark, awards()).toPandas().to_parquet(root / "raw" / "awards.parquet", index=False, coerce_timestamps="us")
    pinned = root / "raw" / "awards.parquet"
    (root / "seeds" / "raw_manifest.json").write_text(json.dumps({"snapshot_date": "2026-01-06", "source": "s", "revision": "r", "files": {"awards.parquet": {"bytes": pinned.stat().st_size, "sha256": io.sha256(pinned)}}}))
    (root / "seeds" / "supplier_pair_pool.json").write_text(json.dumps({"pool_sizes": [400, 20, 0, 0]}))
    return root


def run(spark, root, command):
    return main([command, "--raw", str(root / "raw"), "--seeds", str(root / "seeds"), "--build", str(root / "build"), "--site", str(root / "site"), "--area", "Alpha"], spark)


def load(root, name):
    return json.loads((root / "site" / f"{name}.json").read_text())


@pytest.fixture(scope="module")
def site(spark, place):
    assert run(spark, place, "verify") == 0
    assert run(spark, place, "build") == 0
    assert run(spark, place, "export") == 0
    return place


def test_twelve_documents(site):
    assert sorted(p.stem for p in (site / "site").glob("*")) == DOCUMENTS
    summary = load(site, "summary")
    assert summary["publishable"] is True and summary["counts"]["staged_rows"] == 120 and len(summary["checks"]) == 21 and summary["revision"] == "r"
    assert summary["matching"]["usable_pairs"] == 2 and summary["matching"]["levels"]["3"]["recall"] == 1.0
    assert [r["round_amount"] for r in summary["amounts"]] == [300_000, 500_000, 1_000_000, 1_500_000, 2_000_000]
    agencies = load(site, "agencies")
    assert agencies["awards"] == [120] and agencies["main_area"] == ["Alpha"]
    years = load(site, "agency_years")
    assert years["award_year"] == [2023, 2024] and years["awards"] == [60, 60] and years["under"] == [29, 29] and years["suppliers"] == [3, 3] and years["same_day_groups"] == [2, 2]
    patterns = load(site, "patterns")
    assert sorted(patterns) == ["2023", "2024"] and [r["under"] for r in patterns["2024"]["bunching"]] == [] and patterns["2024"]["same_day"][0]["same_day_groups"] == 2 and patterns["2024"]["concentration"][0]["suppliers"] == 3
    focus = load(site, "focus_area")
    assert [r["award_year"] for r in focus["yearly"]] == [2023, 2024] and focus["agencies"][0]["awards"] == 120 and focus["by_type"][0]["awards"] == 120
    cliff = load(site, "cliff")
    assert cliff["year"] == 2024 and len(cliff["amounts"]["1000000"]) == 40


def test_no_document_names_a_supplier(site):
    for name in DOCUMENTS:
        text = (site / "site" / f"{name}.json").read_text().upper()
        assert not any(word in text for word in ("ACME", "BRAVO", "CHARLIE", "SUPPLIER_ID", "MATCH_KEY")), name


def test_rerun_gives_the_same_bytes_and_clears_old_files(spark, site):
    before = {p.name: p.read_bytes() for p in (site / "site").glob("*.json")}
    (site / "site" / "leftover.json").write_text("{}")
    assert run(spark, site, "export") == 0
    assert {p.name: p.read_bytes() for p in (site / "site").glob("*.json")} == before


def test_labels_and_candidates(spark, site):
    assert run(spark, site, "eval-matching") == 0 and run(spark, site, "sample-pairs") == 0
    report = json.loads((site / "build" / "matching_report.json").read_text())
    assert (report["labelled_pairs"], report["unsure_pairs"], report["level_in_use"]) == (3, 1, 3)
    assert json.loads((site / "build" / "supplier_pair_pool.json").read_text())["floor"] == 0.8


def test_failed_check_blocks_the_export(spark, site):
    report = json.loads((site / "build" / "dq_report.json").read_text())
    for c in report["checks"]:
        c["passed"] = c["name"] != "award_id_unique"
    (site / "build" / "dq_report.json").write_text(json.dumps(report | {"publishable": False}))
    before = {p.name: p.read_bytes() for p in (site / "site").glob("*.json")}
    assert run(spark, site, "export") == 1
    assert {p.name: p.read_bytes() for p in (site / "site").glob("*.json")} == before


def test_other_snapshot_is_refused(spark, place, tmp_path):
    for part in ("raw", "seeds"):
        (tmp_path / part).mkdir()
        for p in (place / part).iterdir():
            (tmp_path / part / p.name).write_bytes(p.read_bytes())
    (tmp_path / "raw" / "awards.parquet").write_bytes(b"x")
    assert run(spark, tmp_path, "verify") == 2 and run(spark, tmp_path, "build") == 2
