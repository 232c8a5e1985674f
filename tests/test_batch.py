"""End-to-end refresh on workbooks written by the test."""

import pytest

from sitelens.operators.quality import GateFailed
from sitelens.plans.batch import refresh
from sitelens.sources.publish import NothingPublished, read_published
from tests.xlsx_util import write_xlsx

SITE_HEADER = [" Site State Abbreviation", "BHCMIS Organization Identification Number",
               "Health Center Name", "Site Name", "Site City", "County Equivalent Name",
               "Health Center Type", "Geocoding Artifact Address Primary Y Coordinate",
               "Geocoding Artifact Address Primary X Coordinate"]


def _sites(n_or=12):
    rows = [SITE_HEADER]
    for i in range(n_or):
        org = 100010 + i % 3
        rows.append(["OR", float(org), f"Org {org}", f"Site {i}", "Springfield", "North County", "Health Center",
                     44.0 + i * 0.1, -122.0])
    rows.append(["WA", 100010.0, "Org X", "Elsewhere", "Riverside", "West County", "Health Center", 47.6, -122.3])
    rows.append(["OR", 999999.0, "Org Z", "No Coordinates", "Lakeview", "East County", "Health Center", None, None])
    return rows


def _orgs():
    return [["BHCMISID", "T4_L6_Ca", "T4_L7_Ca", "T4_L7_Cb", "T4_L8_Ca", "T4_L8_Cb"],
            [100010, 1000, 50, 50, 300, 200], [100011, 500, 10, 0, 100, 150],
            ["Data as of 2024", None, None, None, None, None]]


def test_refresh_end_to_end(spark, tmp_path):
    write_xlsx(str(tmp_path / "sites.xlsx"), {"Sheet1": _sites()})
    write_xlsx(str(tmp_path / "org_metrics.xlsx"), {"Cover": [["x"]], "Table4": _orgs()})
    out = refresh(spark, str(tmp_path / "sites.xlsx"), str(tmp_path / "org_metrics.xlsx"),
                  str(tmp_path / "out"), region="OR", export_csv=True)
    joined = out["joined"]
    assert joined.count() == 12
    assert joined.filter("_matched").count() == 8
    kpi = out["kpi"].first()
    assert (kpi["sites"], kpi["organizations"], kpi["patients"]) == (12, 3, 1500.0)
    mix = {r["Category"]: r["Patients"] for r in out["payer_mix"].collect()}
    assert mix == {"Medicaid": 750.0, "Uninsured": 110.0, "Other (Private/Medicare)": 640.0}
    gate = {r["rule"]: r["passed"] for r in out["quality_gate"].collect()}
    assert gate["gate"] is True


def test_refresh_gate_blocks(spark, tmp_path):
    rows = _sites(n_or=5)
    write_xlsx(str(tmp_path / "sites.xlsx"), {"Sheet1": rows})
    write_xlsx(str(tmp_path / "org_metrics.xlsx"), {"Table4": _orgs()})
    with pytest.raises(GateFailed):
        refresh(spark, str(tmp_path / "sites.xlsx"), str(tmp_path / "org_metrics.xlsx"),
                str(tmp_path / "out"), region="OR")
    with pytest.raises(NothingPublished):
        read_published(spark, str(tmp_path / "out"), "joined")
    write_xlsx(str(tmp_path / "sites.xlsx"), {"Sheet1": _sites()})
    refresh(spark, str(tmp_path / "sites.xlsx"), str(tmp_path / "org_metrics.xlsx"), str(tmp_path / "out"), region="OR")
    write_xlsx(str(tmp_path / "sites.xlsx"), {"Sheet1": rows})
    with pytest.raises(GateFailed):
        refresh(spark, str(tmp_path / "sites.xlsx"), str(tmp_path / "org_metrics.xlsx"),
                str(tmp_path / "out"), region="OR")
    assert read_published(spark, str(tmp_path / "out"), "joined").count() == 12
