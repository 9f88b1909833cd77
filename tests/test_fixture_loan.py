"""Golden values of FIXTURES.md F-A, compared at test time with the 20-row loan
sample CSV named by ``QUILLSTAT_SAMPLE_CSV`` (the file is not copied into the
repository).  ``test_generated_rows`` runs the same schema on generated rows."""

import os

import pytest

from quillstat.operators import eda as E
from quillstat.operators import prepare as D
from quillstat.operators import profile as P
from quillstat.sources.readers import read_table

SAMPLE = os.environ.get("QUILLSTAT_SAMPLE_CSV", "")
NUMERIC = ["age", "income", "education_years", "credit_score", "loan_amount", "defaulted"]


@pytest.fixture(scope="module")
def loan(spark):
    if not SAMPLE or not os.path.exists(SAMPLE):
        pytest.skip("set QUILLSTAT_SAMPLE_CSV to the loan sample CSV")
    return read_table(spark, SAMPLE)


def test_types_and_counts(loan):
    prof = {r["column_name"]: r for r in P.profile(loan).collect()}
    assert prof["job_type"]["semantic_type"] == "categorical"
    assert all(prof[c]["semantic_type"] == "numeric" for c in NUMERIC)
    assert {c: prof[c]["n_unique"] for c in prof} == {
        "age": 20, "income": 20, "education_years": 13, "job_type": 3, "credit_score": 19,
        "loan_amount": 20, "defaulted": 2}
    assert all(r["missing_pct"] == 0.0 for r in prof.values())
    assert abs(prof["job_type"]["distinct_ratio"] - 0.15) < 1e-12


def test_samples_are_smallest_distinct(loan):
    s = P.sample_values(loan).where("column_name = 'job_type'").orderBy("sample_rank").collect()
    assert [r["sample_value"] for r in s] == ["blue_collar", "professional", "white_collar"]


def test_numeric_summary(loan):
    got = {r["column_name"]: r for r in E.numeric_summary(loan, NUMERIC).collect()}
    expect = {"age": (38.75, 11.1633, 23, 60, 0.4931), "income": (49100.0, 18744.5431, 25000, 92000, 0.7934),
              "education_years": (14.95, 3.8041, 10, 22, 0.285), "credit_score": (678.0, 86.7907, 560, 820, 0.2418),
              "loan_amount": (15175.0, 11347.7044, 3000, 45000, 1.2664), "defaulted": (0.35, 0.4894, 0, 1, 0.6812)}
    for c, (mean, std, mn, mx, skew) in expect.items():
        r = got[c]
        assert (r["mean"], r["std"], r["min"], r["max"], r["skew"]) == (mean, std, mn, mx, skew), c


def test_medians_and_population_std(loan):
    med = D.fit_medians(loan, NUMERIC)
    assert med == {"age": 37.0, "income": 46000.0, "education_years": 15.0, "credit_score": 680.0,
                   "loan_amount": 11500.0, "defaulted": 0.0}
    sc = D.fit_scalers(loan, D.impute(med))
    assert round(sc["age"][1], 4) == 10.8806 and round(sc["defaulted"][1], 3) == 0.477


def test_correlation(loan):
    r = {(x["col_x"], x["col_y"]): x["r"] for x in E.correlation(loan, NUMERIC).collect()}
    assert r[("age", "income")] == 0.274
    assert r[("education_years", "credit_score")] == 0.988
    assert r[("credit_score", "defaulted")] == -0.801
    assert r[("age", "age")] == 1.0


def test_top_values_and_codes(loan):
    top = E.top_values(loan, ["job_type"]).orderBy("value_rank").collect()
    assert [(t["value"], t["count"]) for t in top] == [("blue_collar", 8), ("professional", 7), ("white_collar", 5)]
    codes = {r["value"]: r["code"] for r in D.fit_dictionary(loan, ["job_type"]).collect()}
    assert codes == {"blue_collar": 0, "professional": 1, "white_collar": 2}


def test_targets_and_tasks(loan):
    prof = P.profile(loan)
    assert [r["task"] for r in P.suggest_tasks(prof).orderBy("position").collect()] == [
        "anomaly_detection", "clustering", "classification", "regression"]
    clf = [r["column_name"] for r in P.targets_for_task(prof, "classification").orderBy("position").collect()]
    assert clf == ["age", "income", "education_years", "job_type", "credit_score", "loan_amount", "defaulted"]
    reg = [r["column_name"] for r in P.targets_for_task(prof, "regression").orderBy("position").collect()]
    assert reg == ["age", "income", "education_years", "credit_score", "loan_amount"]
    assert P.collect_info(prof).small_data


def test_generated_rows(spark, tmp_path):
    """Same schema as the sample, 20 generated rows written as CSV and read back."""
    jobs = ["blue_collar", "white_collar", "professional"]
    lines = ["age,income,education_years,job_type,credit_score,loan_amount,defaulted"]
    for i in range(20):
        lines.append(f"{22 + 2 * i},{25000 + 3000 * i},{10 + i % 13},{jobs[i % 3]},{560 + 13 * i},"
                     f"{3000 + 2000 * i},{i % 2}")
    path = tmp_path / "loan.csv"
    path.write_text("\n".join(lines) + "\n")
    df = read_table(spark, str(path))
    assert dict(df.dtypes) == {"age": "bigint", "income": "bigint", "education_years": "bigint",
                               "job_type": "string", "credit_score": "bigint", "loan_amount": "bigint",
                               "defaulted": "bigint"}
    prof = P.profile(df)
    types = {r["column_name"]: r["semantic_type"] for r in prof.collect()}
    assert types["job_type"] == "categorical" and types["age"] == "numeric"
    clf = [r["column_name"] for r in P.targets_for_task(prof, "classification").orderBy("position").collect()]
    assert clf == ["age", "income", "education_years", "job_type", "credit_score", "loan_amount", "defaulted"]
    reg = [r["column_name"] for r in P.targets_for_task(prof, "regression").orderBy("position").collect()]
    assert reg == ["age", "income", "education_years", "credit_score", "loan_amount"]
    assert P.collect_info(prof).small_data
