import datetime as dt
import json
import os
from unittest import mock

import pytest

from shoplake.__main__ import main
from shoplake.plans import gold, pipeline, silver
from shoplake.plans.reports import REPORTS
from shoplake.sources.bronze import land, read_records
from shoplake.sources.versions import current, mark
from shoplake.sources.tables import GOLD, SILVER, gather, read_layer, read_reports

AS_OF = dt.date(2025, 1, 1)
RUN_TS = dt.datetime(2025, 1, 1, 6)


@pytest.fixture(params=["documents", "lines"])
def landed(request, spark, samples, tmp_path):
    layout, line, cart = request.param, samples["line"], samples["carts"]
    records = {
        "products": [samples["products"] | {"id": i, "price": 9.5 - i} for i in range(9)]
        + [samples["products"]],
        "users": [samples["users"] | {"id": i, "age": 28 + i} for i in range(6)]
        + [samples["users"] | {"id": 9, "email": "none"}],
        "carts": [
            cart
            | {
                "id": i,
                "userId": i % 3,
                "products": [line | {"id": i + k, "quantity": k} for k in range(3)],
            }
            for i in range(6)
        ],
    }
    for entity, rows in records.items():
        folder = tmp_path / "in" / entity
        folder.mkdir(parents=True)
        if layout == "documents":
            (folder / "a.json").write_text(json.dumps({entity: rows}))
        else:
            (folder / "a.json").write_text("\n".join(map(json.dumps, rows)))
    root = str(tmp_path / "bronze")
    sources = {entity: str(tmp_path / "in" / entity) for entity in records}
    land(spark, sources, root, layout, RUN_TS)
    return root, layout


def test_the_whole_flow(spark, landed, tmp_path, rows):
    (root, layout), out = landed, str(tmp_path / "out")
    counts = pipeline.run_all(spark, root, out, layout, AS_OF, RUN_TS)

    tables = read_layer(spark, out, SILVER + GOLD)
    raw = {e: read_records(spark, f"{root}/{e}", e, layout) for e in ("products", "users", "carts")}
    products = silver.products(raw["products"], RUN_TS)
    users = silver.users(raw["users"], AS_OF, RUN_TS)
    items = silver.cart_items(raw["carts"], RUN_TS)
    expected = {
        "products": products,
        "users": users,
        "cart_summary": silver.cart_summary(raw["carts"], RUN_TS),
        "cart_items": items,
        "customer_360": gold.customer_360(users, items, products, RUN_TS),
        "product_performance": gold.product_performance(products, items, RUN_TS),
        "stock_risk": gold.stock_risk(products, items, RUN_TS),
    }
    for name, df in expected.items():
        assert rows(tables[name].select(df.columns)) == rows(df), name

    # One gold row per row of the table it is built on; shares add up to the rows.
    assert tables["customer_360"].count() == tables["users"].count() == 6
    for name, share in (("product_performance", "demand_tier"), ("stock_risk", "risk_level")):
        report = counts[f"gold_{name}"]
        parts = [v for k, v in report.items() if k.startswith(f"{share}/")]
        assert sum(parts) == report["steps/row_count"] == tables["products"].count()

    assert counts["users_silver"]["dropped/total"] == 1
    assert counts["products_silver"]["dropped/failed_quality_filters"] == 0
    assert counts["products_silver"]["steps/01_after_bronze_read"] == 10
    carts = counts["carts_silver"]
    assert carts["steps/01_after_bronze_read"] == 6
    assert carts["steps/03_cart_items_ready"] == tables["cart_items"].count() == 12
    assert carts["dropped/total"] == carts["rejected/cart_items.quantity_positive"] == 6
    reports = {r.pipeline for r in read_reports(spark, out).select("pipeline").distinct().collect()}
    assert reports == set(counts) and len(reports) == 6


def test_gold_tables_go_to_the_database_from_their_files(spark, landed, tmp_path):
    (root, layout), out = landed, str(tmp_path / "out")
    with mock.patch.object(pipeline, "write_jdbc") as write:
        pipeline.run_all(spark, root, out, layout, AS_OF, RUN_TS, jdbc={"url": "u"})
    assert [call.args[1] for call in write.call_args_list] == [
        "gold_customer_360",
        "gold_product_performance",
        "gold_stock_risk",
    ]
    assert all(call.args[0].inputFiles() for call in write.call_args_list)
    assert all(call.kwargs == {"config": {"url": "u"}} for call in write.call_args_list)


def test_a_second_run_replaces_the_first(spark, landed, tmp_path):
    (root, layout), out = landed, str(tmp_path / "out")
    for _ in range(2):
        pipeline.run_all(spark, root, out, layout, AS_OF, RUN_TS)
    assert read_layer(spark, out, ["customer_360"])["customer_360"].count() == 6
    reports = read_reports(spark, out)
    assert reports.count() == reports.distinct().count()


def test_a_stopped_run_is_taken_up_again(spark, landed, tmp_path, rows, monkeypatch):
    (root, layout), out = landed, str(tmp_path / "out")

    def versions():
        paths = [f"{out}/silver/{n}" for n in SILVER] + [f"{out}/gold/{n}" for n in GOLD]
        return {p.rsplit("/", 1)[1]: m["version"] for p in paths if (m := mark(spark, p))}

    with monkeypatch.context() as patched:
        patched.setattr(pipeline, "write_gold", mock.Mock(side_effect=RuntimeError("stopped")))
        with pytest.raises(RuntimeError, match="stopped"):
            pipeline.run_all(spark, root, out, layout, AS_OF, RUN_TS)
    first = versions()
    assert first.keys() == set(SILVER)

    again = pipeline.run_all(spark, root, out, layout, AS_OF, RUN_TS, resume=True)
    second = versions()
    assert {n: second[n] for n in SILVER} == first and second.keys() == {*SILVER, *GOLD}
    whole = pipeline.run_all(spark, root, str(tmp_path / "whole"), layout, AS_OF, RUN_TS)
    assert again == whole

    # Nothing is written a third time, unless it has another input.
    assert pipeline.run_all(spark, root, out, layout, AS_OF, RUN_TS, resume=True) == whole
    assert versions() == second
    pipeline.run_all(spark, root, out, layout, dt.date(2025, 6, 1), RUN_TS, resume=True)
    changed = {n for n, v in versions().items() if v != second[n]}
    assert changed == {"users", "customer_360"}


def test_reports_say_what_was_written_removed_and_where_levels_end(spark, landed, tmp_path):
    (root, layout), out = landed, str(tmp_path / "out")
    pipeline.run_all(spark, root, out, layout, AS_OF, RUN_TS, user_buckets=3)
    found = {(r.pipeline, r.section, r.name): r for r in read_reports(spark, out).collect()}
    assert found["users_silver", "steps", "05_written"].value == 6
    assert found["carts_silver", "steps", "05_written"].value == 6 + 12
    assert found["gold_stock_risk", "thresholds", "high"].value == 5
    removed = {name for p, section, name in found if section == "removed_fields"}
    assert {"password", "bank.iban", "crypto"} <= removed and "email" not in removed
    assert all(r.note for r in found.values())
    assert os.path.exists(f"{current(spark, f'{out}/silver/cart_items')}/user_bucket_of_3=0")


@pytest.mark.parametrize("layout", ["documents", "lines"])
def test_malformed_input_ends_the_run_or_is_counted_apart(spark, samples, tmp_path, layout):
    cart = samples["carts"]
    for entity in ("products", "users", "carts"):
        folder = tmp_path / "bronze" / entity
        folder.mkdir(parents=True)
        record = json.dumps(samples[entity])
        (folder / "a.json").write_text(record if layout == "lines" else f'{{"{entity}": [{record}]}}')
    many = [json.dumps(cart | {"id": 100 + i}) for i in range(3)]
    broken = [m[:-5] for m in many] if layout == "lines" else [f'{{"carts": [{", ".join(many)}'[:-5]]
    (tmp_path / "bronze/carts/b.json").write_text("\n".join(broken))
    root, out = str(tmp_path / "bronze"), str(tmp_path / "out")
    with pytest.raises(Exception, match="(?i)malformed|corrupt"):
        pipeline.run_all(spark, root, out, layout, AS_OF, RUN_TS)
    counts = pipeline.run_all(spark, root, out, layout, AS_OF, RUN_TS, malformed="aside")
    carts = counts["carts_silver"]
    assert carts["dropped/malformed"] == len(broken)
    assert (carts["steps/01_after_bronze_read"], carts["dropped/duplicates"]) == (1, 0)
    assert counts["products_silver"]["dropped/malformed"] == 0
    aside = " ".join(r.value for r in spark.read.text(f"{root}/malformed/carts").collect())
    assert all(f'"id": {100 + i}' in aside for i in range(3))


def test_no_job_dies_of_one_amount(spark, raw, samples):
    line = samples["line"]
    odd = [("discountedTotal", 1e30), ("price", "NaN"), ("total", "Infinity"), ("quantity", 3)]
    lines = [line | {"id": i, name: value} for i, (name, value) in enumerate(odd)]
    items = silver.cart_items(raw("carts", [samples["carts"] | {"products": lines}]), RUN_TS)
    assert sorted(r.product_id for r in items.collect()) == [2, 3]
    assert gold.product_demand(items).count() == 2
    (bought,) = gold.user_purchases(items).collect()
    assert bought.total_spend == 36.0
    kept = silver.products(raw("products", [samples["products"] | {"price": p} for p in ("NaN", 1e30)]))
    assert kept.count() == 0


def test_command_line(spark, samples, tmp_path, capsys):
    for entity in ("products", "users", "carts"):
        folder = tmp_path / "in" / entity
        folder.mkdir(parents=True)
        (folder / "a.json").write_text(json.dumps({entity: [samples[entity]]}))
    source, root, out = (str(tmp_path / name) for name in ("in", "bronze", "out"))
    main(["land", "--source", source, "--bronze", root])
    main(["run", "--bronze", root, "--out", out, "--as-of", "2025-01-01"])
    capsys.readouterr()
    main(["report", "top_spenders", "--out", out, "--rows", "5"])
    assert "Ada Lee" in capsys.readouterr().out
    for wrong in (["nothing", "--out", out, "--rows", "5"], ["top_spenders", "--out", out]):
        with pytest.raises(SystemExit):
            main(["report", *wrong])
    tables = read_layer(spark, out, SILVER)
    for name, report in REPORTS.items():
        assert report(tables).collect() is not None, name


def test_a_report_is_written_whole(spark, samples, tmp_path):
    products = [samples["products"] | {"id": i, "stock": 0} for i in range(1500)]
    line = samples["line"]
    carts = [samples["carts"] | {"id": i, "products": [line | {"id": i}]} for i in range(1500)]
    for entity, rows in (("products", products), ("users", [samples["users"]]), ("carts", carts)):
        folder = tmp_path / "bronze" / entity
        folder.mkdir(parents=True)
        (folder / "a.json").write_text("\n".join(map(json.dumps, rows)))
    root, out, to = (str(tmp_path / name) for name in ("bronze", "out", "report"))
    main(["run", "--bronze", root, "--out", out, "--layout", "lines", "--user-buckets", "2"])
    main(["report", "nearly_out_of_stock", "--out", out, "--to", to])
    assert spark.read.csv(to, header=True).select("id").distinct().count() == 1500


def test_unknown_gold_table(spark):
    with pytest.raises(ValueError):
        pipeline.write_gold_table("nothing", {"products": None, "cart_items": None}, "/nowhere")


def test_empty_sources(spark, raw, tmp_path):
    records = {entity: raw(entity, []) for entity in ("products", "users", "carts")}
    out = str(tmp_path / "out")
    observed = pipeline.write_silver(records, out, AS_OF, RUN_TS)
    reports = pipeline.silver_reports(observed)
    assert {v for counts in reports.values() for v in counts.values()} == {0, None}
    tables = read_layer(spark, out, SILVER)
    for name, counts in pipeline.write_gold(tables, out, RUN_TS).items():
        assert set(counts.values()) == {0}, name
    assert read_layer(spark, out, GOLD)["customer_360"].count() == 0


def test_sources_without_a_valid_row(spark, raw, samples, tmp_path):
    records = {
        "products": raw("products", [samples["products"] | {"price": 0}]),
        "users": raw("users", [samples["users"] | {"email": None}]),
        "carts": raw("carts", [samples["carts"] | {"total": -1, "products": None}]),
    }
    out = str(tmp_path / "out")
    counts = pipeline.silver_reports(pipeline.write_silver(records, out, AS_OF, RUN_TS))
    assert counts["products_silver"]["dropped/failed_quality_filters"] == 1
    assert counts["carts_silver"]["rejected/cart_summary.total_not_negative"] == 1
    assert read_layer(spark, out, ["users"])["users"].count() == 0


def test_rows_that_fail_are_moved_for_their_count_alone(spark, samples, raw, tmp_path, rows):
    """What follows from other columns isn't moved either, and the stored rows are the same."""
    line = samples["line"]
    lines = [line | {"id": i, "price": i % 2 * 3.5, "title": "long title " * 40} for i in range(400)]
    lines += [line | {"id": 3, "quantity": 1}, line | {"id": 5, "price": 0}]
    carts = [samples["carts"] | {"id": i, "userId": i % 9 or None, "products": lines} for i in range(40)]
    source = raw("carts", carts, "lines")
    moved = []

    def gathered(df, by):
        moved.append(df)
        return gather(df, by)

    with mock.patch.object(pipeline, "gather", gathered):
        counts = pipeline.write_silver_table(silver.CART_ITEMS, source, str(tmp_path), None, RUN_TS)
    assert counts["rejected/price_positive"] == 40 * 201 and counts["steps/05_written"] == 40 * 199
    expected = silver.cart_items(source, RUN_TS)
    stored = read_layer(spark, str(tmp_path), ["cart_items"])["cart_items"]
    assert rows(stored.select(expected.columns)) == rows(expected)
    assert "line_total_recomputed" not in moved[0].columns
    failed = moved[0].where("failed_rule is not null")
    assert failed.count() == 40 * 201 and failed.where("product_title is not null").count() == 0
