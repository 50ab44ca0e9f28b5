"""Reports on small tables made by hand."""

from pyspark.sql import functions as F

from quayside.plans import fares
from quayside.plans.fares import fare
from quayside.reports import naming, orders, revenue, settlement


def test_adjustment_sales_count_as_trip_revenue(spark, sf):
    day, other = "2024-01-05 08:00:00", "2024-01-05 09:00:00"
    sale = "transaction_dtm string, dw_transaction_id long, sale_type_key int, reason_key int, media_type_key long, tap_id long, transit_account_id long, operating_day_key int, settlement_day_key int, posting_day_key int, device_id long"
    keys = (20240105, 20240106, 20240106)
    made = {
        "sale_adjustments": ([
            (day, 1, 22, 990951, 1, 11, 5, *keys, 9), (day, 2, 22, 990962, 1, None, 5, *keys, 9),  # counted: read twice, no tap
            (day, 3, 20, 990951, 1, 11, 5, *keys, 9), (day, 4, 22, 990508, 1, 11, 5, *keys, 9),  # type, reason
            (day, 5, 22, 990951, 0, 11, 5, *keys, 9), (other, 6, 22, 990951, 1, 11, 5, *keys, 9), (day, 7, 22, 990951, 1, 11, 5, None, *keys[1:], 9),  # media, time, day
        ], sale),
        "sale_payments": ([(n, day, 100 * n, "r") for n in range(1, 8)] + [(2, day, -7, "r")], "dw_transaction_id long, transaction_dtm string, payment_value long, retrieval_ref_nbr string"),
        "reads": ([(11, 1, 1), (11, 2, None)], "tap_id long, operator_key long, card_key long"),
        "txn_channel_map": ([("UseTxn", 14, 2, "b"), ("UseTxn", 14, 4, "c"), ("UseTxn", 8, 2, "tap"), ("SalesTxn", 14, 2, "d")], "txn_source string, sales_channel_key int, payment_type_key int, txn_channel_display string"),
    }
    t = lambda name: spark.createDataFrame(*made[name]) if name in made else fare(spark, sf, name)
    taps = revenue.tap_revenue(t).count()
    rows = revenue.trip_revenue(t)
    assert rows.count() == taps + 4
    got = [(r.dw_transaction_id, r.fare_revenue, r.operator_name is None, r.txn_channel_display) for r in rows.filter("patron_trip_id is null").collect()]
    assert sorted(got) == [(1, 100, False, "b"), (1, 100, False, "b"), (2, -7, True, "c"), (2, 200, True, "c")]


def test_a_rule_without_postings_is_ignored_and_sides_swap(spark, sf):
    made = {
        "rule_sets": ([(1, "set")], "cch_rules_set_id int, cch_rules_set_name string"),
        "gl_rule_map": ([(k, 1, 7) for k in (1, 2, 3)] + [(1, 2, 7)], "rule_id int, cch_rules_set_id int, transaction_category int"),
        "gl_rules": ([(1, "plain", None, 10, 20, "E"), (2, "negative", 1, 10, 20, "E"), (3, "unused", 0, 10, 20, "E")],
                     "rule_id int, rule_name string, negative_amount_flag int, rule_from_account_id int, rule_to_account_id int, legal_entity_code string"),
        "gl_accounts": ([(10, "E", "from", "h"), (20, "E", "to", "h"), (20, "F", "other", "h")], "account_id int, legal_entity_code string, account_name string, account_holder string"),
        "gl_summary": ([(n, r, 1, 7, a) for n, (r, a) in enumerate([(1, 500), (1, -500), (2, 500), (2, -500), (2, None)])], "gl_posting_id int, rule_id int, cch_rules_set_id int, transaction_category int, amount long"),
    }
    none = ("summary_period date", "posted_dtm timestamp", "gl_summary_record_status_key int", "processing_type_id int", "user_ref_1 string", "user_ref_2 string", "user_ref_3 string", "legal_entity_code string")

    def t(name):
        df = spark.createDataFrame(*made[name]) if name in made else fare(spark, sf, name)
        return df.selectExpr("*", *(f"cast(null as {c.split()[1]}) as {c.split()[0]}" for c in none)) if name == "gl_summary" else df

    got = [(r.apportionment_rule_name, r.absolute_value_amount, r.debit_account_name, r.credit_account_name, r.gl_record_status_name) for r in settlement.ledger_summary(t).orderBy("record_id").collect()]
    assert got == [
        ("unused", None, "to", "from", "Ignored-$0"), ("plain", 5.0, "to", "from", None), ("plain", 5.0, "from", "to", None),
        ("negative", 5.0, "to", "from", None), ("negative", 5.0, "from", "to", None), ("negative", None, "from", "to", None),
    ]


def test_a_table_that_only_maps_rows_is_read_where_its_source_lies(spark, sf):
    source = fare(spark, sf, "fare_base").inputFiles()
    rows = settlement.unsettled_device_cash(lambda name: fare(spark, sf, name))
    assert rows.inputFiles() == source
    assert fare(spark, sf, "cards").inputFiles() == spark.read.parquet(f"{sf}/part.parquet").inputFiles()


def test_clearing_transactions_of_equal_or_missing_keys_meet_their_uses(spark, sf):
    rows = fare(spark, sf, "clearing").limit(1).drop("transaction_id", "fare_prod_key", "transaction_category")
    keys = spark.createDataFrame([(1, 5, 1), (1, 5, 1), (1, None, 1), (2, 5, 1), (None, None, 1), (1, 5, 99)], "transaction_id long, fare_prod_key long, transaction_category int")
    uses = spark.createDataFrame([(1, 70), (1, 71), (None, 72), (3, 73)], "transaction_id long, pass_id long")
    made = {"clearing": rows.crossJoin(keys), "use_txn": uses}
    t = lambda name: made[name] if name in made else fare(spark, sf, name)
    got = sorted((r.transaction_id or 0, r.pass_id or 0) for r in orders.clearing_house_passes(t).collect())
    assert got == [(0, 0), (1, 70), (1, 70), (1, 70), (1, 71), (1, 71), (1, 71), (2, 0)]


def test_facts_are_cut_to_what_a_report_shows_before_they_are_joined(spark):
    schedule = spark.createDataFrame([(20240128, 20240115, 20240131, 20240115, 20240110, 20240112, 20240129)], "due_day_key int, comp_operating_day_key int, comp_max_settlement_day_key int, adden_max_operating_day_key int, adden_min_settlement_day_key int, adden_max_settlement_day_key int, deposit_due_day_key int")
    rows = spark.createDataFrame([(1, 20240115, 20240111), (2, 20240116, 20240111), (3, 20240115, 20240113), (4, 20240115, 20240201), (5, None, 20240111)], "id int, operating_day_key int, settlement_day_key int")
    ids = lambda cut: sorted(r.id for r in cut.collect())
    assert ids(revenue.in_addendum(rows, schedule)) == ids(revenue.addendum(rows, schedule)) == [1]
    assert ids(revenue.in_computation(rows, schedule)) == ids(revenue.computation(rows, schedule)) == [1, 3]
    assert ids(revenue.in_addendum(rows.drop("operating_day_key"), schedule)) == [1, 2, 5]
    assert ids(revenue.in_computation(rows.drop("settlement_day_key"), schedule)) == [1, 3, 4]
    assert ids(revenue.in_addendum(rows.drop("settlement_day_key"), schedule)) == [1, 2, 3, 4, 5]


def test_names_of_several_keys_are_looked_up_by_moving_the_rows_once(spark):
    rows = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (None, 2, "c"), (3, None, "d"), (None, None, "e")], "x int, y int, v string")
    xs, ys = spark.createDataFrame([(1, "x1"), (1, "again"), (3, "x3")], "x int, xn string"), spark.createDataFrame([(1, "y1"), (2, "y2")], "y int, yn string")
    names = lambda keys: naming.attach(naming.attach(keys, xs, {"x": "x"}, ["xn"]), ys, {"y": "y"}, ["yn"])
    found = naming.lookup(rows, names, ["x", "y"])
    assert found.columns == ["x", "y", "v", "xn", "yn"]
    assert sorted(map(repr, found.collect())) == sorted(map(repr, names(rows).collect())) and found.count() == 7


def test_order_lines_move_once_to_meet_products_and_cards(spark, sf):
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        plan = orders.order_detail(lambda name: fare(spark, sf, name))._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set(setting, before)
    # the lookups by keys of lines are over their distinct keys
    assert "Aggregate [l_fare_prod_key" in plan


def test_uses_of_a_trip_are_dealt_once_and_meet_the_sales_of_its_payments(spark, sf):
    use = {
        "patron_trip_id": "long", "source": "string", "trip_price_count": "int", "dw_transaction_id": "long", "transaction_dtm": "string", "device_id": "long", "transit_account_id": "long",
        "transfer_sequence_nbr": "int", "operator_key": "long", "card_key": "long", "media_type_key": "long", "ride_type_key": "int", "txn_status_key": "int", "fare_due": "long", "value_changed": "long",
        "bankcard_payment_value": "long", "retrieval_ref_nbr": "string", "token_id": "string", "operating_day_key": "int", "settlement_day_key": "int", "posting_day_key": "int", "uncollectible_amount": "long",
    }
    fixed = {"transaction_dtm": "2024-01-05", "retrieval_ref_nbr": "r", "token_id": "t", "operating_day_key": 20240105, "settlement_day_key": 20240106, "posting_day_key": 20240106, "ride_type_key": 1, "media_type_key": 1}

    def taps(*keys):
        rows = [dict.fromkeys(use, 1) | fixed | dict(zip(("dw_transaction_id", "patron_trip_id", "source", "trip_price_count"), k, strict=True)) for k in keys]
        return [tuple(r[c] for c in use) for r in rows]

    made = {
        "use_txn": (taps((1, 7, "A", 1), (2, 7, "A", 2), (3, 7, "B", 1), (4, 7, None, 1), (5, None, "A", 1), (6, 8, "A", 1), (7, 9, "A", 1)), ", ".join(f"{c} {x}" for c, x in use.items())),
        "patron_trip": ([(7, "A", "rule"), (7, "A", "again"), (7, "B", "b"), (8, "A", "other"), (None, "A", "no trip"), (7, None, "no source")], "patron_trip_id long, source string, fare_rule_description string"),
        "trip_payment": (
            [
                (7, 1, 10, 20, 100, 3, 5, 0, 0, "p", "A"), (7, 1, 10, None, 1000, 3, 5, 0, 0, "p", "A"),  # two payments of one sale
                (7, 2, None, None, 40, 3, 5, 0, 0, "p", "A"), (7, 1, 11, 20, 50, 3, 5, 0, 0, "p", "B"), (8, 1, 99, 99, 60, 3, 5, 0, 0, "p", "A"), (7, 1, 10, 20, 7, 3, 5, 0, 0, "p", None),
            ],
            "patron_trip_id long, trip_price_count int, purse_load_id long, bankcard_payment_id long, bankcard_value long, stored_value long, uncollectible_amount long, is_reversal int, je_is_fare_adjustment int, transaction_dtm string, source string",
        ),
        "sale_txn": (
            [(10, None, 26, 0, "l"), (10, None, 26, 0, "l"), (None, 20, 20, 1, "s1"), (None, 20, 20, 3, "s2"), (None, 20, 20, 4, "kind"), (11, None, 20, 1, "x"), (None, None, 26, 1, "n")],
            "purse_load_id long, bankcard_payment_id long, sale_type_key int, bankcard_payment_type_key int, retrieval_ref_nbr string",
        ),
    }
    t = lambda name: spark.createDataFrame(*made[name]) if name in made else fare(spark, sf, name)
    rows = revenue.tap_revenue(t)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    dealt = [line.split("hashpartitioning(")[1].split(", 4)")[0] for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    # uses, trips, payments and both kinds of sales by trip; no sum and no join deals by more keys
    assert sum("patron_trip_id" in keys for keys in dealt) == 5 and not any("," in keys for keys in dealt)
    got = sorted((r.dw_transaction_id, r.fare_rule_description, r.retrieval_ref_nbr or "", r.fare_revenue) for r in rows.collect())
    # 2 late sales: (100 + 5 + 3) and (1000 + 5 + 3) twice each; no late sale: 40 + 5, 50 + 5 and 60 + 5
    first = [(1, rule, ref, n) for rule in ("again", "rule") for ref, n in (("", -2016), ("s1", -216), ("s2", -216))]
    assert got == [*first, (2, "again", "", -45), (2, "rule", "", -45), (3, "b", "s1", -55), (3, "b", "s2", -55), (6, "other", "", -65)]
    few = revenue.tap_revenue(t, few=True)
    assert sorted(map(repr, few.collect())) == sorted(map(repr, rows.collect()))


def test_payments_of_other_sources_leave_before_they_are_joined(spark, sf, monkeypatch):
    monkeypatch.setattr(fares, "_MADE", {})
    tables = sorted(f for name in ("lineitem", "orders") for f in spark.read.parquet(f"{sf}/{name}.parquet").inputFiles())
    assert sorted(fare(spark, sf, "payment_summary").inputFiles()) == tables  # no base is written for a fact read once
    plan = revenue.component_d(lambda name: fare(spark, sf, name))._jdf.queryExecution().optimizedPlan().toString()
    assert any("array_contains" in line and "l_orderkey" in line for line in plan.splitlines())
    base = fare(spark, sf, "fare_base").inputFiles()
    assert fare(spark, sf, "payment_summary").inputFiles() == base
    keys = "txn_source string, sales_channel_key long, payment_type_key int"
    made = {
        "payment_summary": ([("R", 1, 1, 5, 100), ("R", 1, 1, 5, 20), ("R", 1, 2, 5, 3), ("S", 1, 1, 6, 40), (None, 1, 1, 5, 7), ("X", 1, 1, 5, 9)], keys + ", reason_key long, payment_value long"),
        "txn_channel_map": ([("R", 1, 1, "Direct Refunds Applied"), ("S", 1, 1, "Direct Refunds Applied"), ("X", 1, 1, "Product Sales"), (None, 1, 1, "Direct Refunds Applied")], keys + ", txn_group string"),
        "reasons": ([(5, "five")], "reason_key long, reason_name string"),
    }

    def t(name, drop=""):
        df = spark.createDataFrame(*made[name])
        if name == "payment_summary":
            return df.selectExpr("*", "1 as settlement_day_key", "2 as operating_day_key")
        return df.selectExpr("*", "'c' as txn_channel_display", "'s' as sales_channel_display").filter(f"txn_group <> '{drop}'") if name == "txn_channel_map" else df

    got = sorted((r.reason_name or "", r.refund_value) for r in revenue.component_d(t).collect())
    assert got == [("", 0.4), ("five", 1.2)]
    assert revenue.component_d(lambda name: t(name, "Direct Refunds Applied")).collect() == []


def test_uses_and_payments_of_a_trip_meet_where_they_are_written(spark, sf, monkeypatch):
    monkeypatch.setattr(fares, "_MADE", {})
    base = fare(spark, sf, "fare_base")
    buckets = spark.sparkContext.defaultParallelism
    assert len(base.inputFiles()) <= buckets  # a bucket is one task's, however many write
    assert base.select("order_id", F.input_file_name()).distinct().count() == base.select("order_id").distinct().count()
    assert base.count() == spark.read.parquet(f"{sf}/lineitem.parquet").count()
    assert "Repartition" not in spark.table("lineitem")._jdf.queryExecution().optimizedPlan().toString()
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        rows = revenue.tap_revenue(lambda name: F.broadcast(fare(spark, sf, name)) if name == "media_types" else fare(spark, sf, name))
        plan = rows._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(repr, rows.collect()))
    finally:
        spark.conf.set(setting, before)
    dealt = [line.split("hashpartitioning(")[1] for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    # only trips and both kinds of sales go to the buckets; uses and payments stay in theirs
    assert sum("patron_trip_id" in keys for keys in dealt) == 3
    plain = {"use_txn", "trip_payment"}
    moved = revenue.tap_revenue(lambda name: fare(spark, sf, name).repartition(3) if name in plain else fare(spark, sf, name))
    assert got == sorted(map(repr, moved.collect())) and got


def _met_in_place(spark, monkeypatch, large, report, sf):
    """The keys by which a report over large tables deals rows, its rows, and its rows over tables that lie otherwise."""
    monkeypatch.setattr(fares, "_MADE", {})
    fare(spark, sf, "fare_base")
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    t = lambda name: fare(spark, sf, name) if name in large else F.broadcast(fare(spark, sf, name))
    spark.conf.set(setting, "-1")
    try:
        rows = report(t)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(repr, rows.collect()))
    finally:
        spark.conf.set(setting, before)
    dealt = [line.split("hashpartitioning(")[1].rsplit("), ", 1)[0] for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    return dealt, got, sorted(map(repr, report(lambda name: fare(spark, sf, name).repartition(3)).collect()))


def test_orders_lines_and_payments_meet_where_they_lie(spark, sf, monkeypatch):
    large = {"patron_order", "order_line_item", "order_payment", "products", "cards", "transit_accounts"}
    for report in (orders.order_lines, orders.adjustments):
        dealt, got, moved = _met_in_place(spark, monkeypatch, large, report, sf)
        # orders come by their key in their table's few columns, and what was found for lines; no line and no payment is moved
        assert sum("o_orderkey" in keys for keys in dealt) == 1 and sum("l_dw_patron_order_id" in keys for keys in dealt) == 1
        assert not any("line_item_id" in keys or "p_" in keys.replace("fare_p", "") for keys in dealt)
        assert got == moved and got


def test_keys_of_a_group_are_looked_up_and_rows_without_one_too(spark):
    rows = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (1, None, "c"), (2, 1, "d"), (2, 9, "e"), (None, 1, "f"), (None, None, "g")], "g int, x int, v string")
    xs = spark.createDataFrame([(1, "x1"), (1, "again"), (3, "x3")], "x int, xn string")
    names = lambda keys: naming.attach(keys, xs, {"x": "x"}, ["xn"])
    want = sorted(map(repr, names(rows).collect()))
    assert sorted(map(repr, naming.lookup_all(rows, names, ["x"], "g").collect())) == want
    within = naming.lookup_within(rows, names, ["x"], "g")
    assert sorted(map(repr, within.collect())) == [r for r in want if "g=None" not in r] and within.columns == ["g", "x", "v", "xn"]


def test_only_lines_that_a_report_shows_are_looked_up(spark, sf):
    plan = orders.adjustments(lambda name: fare(spark, sf, name))._jdf.queryExecution().optimizedPlan().toString()
    # where lines are read for the report, and where for their keys
    assert sum("Filter" in line and "Adjustment" in line for line in plan.splitlines()) >= 2


def test_distinct_uses_stay_where_they_lie(spark, sf, monkeypatch):
    dealt, got, moved = _met_in_place(spark, monkeypatch, {"unsettled", "products"}, settlement.unsettled_uses, sf)
    # what was found for the orders' keys comes to the orders; no use is moved
    assert sum("order_nbr" in keys for keys in dealt) == 1 and not any("retrieval_ref_nbr" in keys for keys in dealt)
    assert got == moved and got


def test_rows_that_share_a_hash_are_compared_in_full(spark, monkeypatch):
    rows = spark.createDataFrame([(1, None, 7), (1, 0, 7), (1, 0, 8), (2, 0, 7), (3, 5, 9), (None, None, None), (None, None, None)], "a int, b int, k int")
    sides = spark.createDataFrame([(7, "x"), (7, "y"), (8, "x"), (9, "x")], "k int, name string")
    names = lambda rows: naming.attach(rows, sides, {"k": "k"}, ["name"])
    want = sorted(map(repr, names(rows).selectExpr("coalesce(b, 0) as b", "a", "name").distinct().collect()))
    for most in (naming.MOST_SHARED, 0):
        monkeypatch.setattr(naming, "MOST_SHARED", most)
        found = naming.distinct_rows(rows, [naming.zero("b").alias("b"), "a"], names, ["name"])
        assert sorted(map(repr, found.collect())) == want and len(want) == 6
    alone = naming.distinct_rows(rows.filter("a > 1"), ["a"], names, ["name"])
    assert sorted(tuple(r) for r in alone.collect()) == [(2, "x"), (2, "y"), (3, "x")]


def test_uses_are_distinct_whatever_their_names(spark, sf):
    use = fare(spark, sf, "unsettled").limit(1).drop("fare_prod_key", "order_nbr", "benefit_value")
    keys = spark.createDataFrame([(1, 5, None), (2, 5, 0), (None, 6, 0), (3, 8, 0), (4, None, 0), (5, 5, 300)], "order_nbr long, fare_prod_key long, benefit_value long")
    made = {
        "unsettled": use.crossJoin(keys),
        # two keys of one name, and a key twice under it
        "products": spark.createDataFrame([(5, "p"), (5, "p"), (6, "p"), (8, "q"), (8, "r")], "fare_prod_key long, fare_prod_name string"),
    }
    rows = settlement.unsettled_uses(lambda name: made[name] if name in made else fare(spark, sf, name))
    assert sorted((r.fare_prod_name or "", r.benefit_value) for r in rows.collect()) == [("", 0.0), ("p", 0.0), ("p", 3.0), ("q", 0.0), ("r", 0.0)]


def test_clearing_transactions_stay_where_they_lie(spark, sf, monkeypatch):
    dealt, got, moved = _met_in_place(spark, monkeypatch, {"clearing", "use_txn", "products"}, orders.clearing_house_passes, sf)
    # what was found for the orders' keys comes to the orders, and keys alone go to uses and products
    assert sum("order_nbr" in keys for keys in dealt) == 1 and not any("isnull" in keys for keys in dealt)
    assert got == moved and got
