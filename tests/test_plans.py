"""Physical plans: what must and must not be in them."""

import pytest

from emberlog.operators import anomalies, data_tests, explore, mapping, marts, staging, validate
from emberlog.plans import bridge, registry
from emberlog.sources import benchmark

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored"))
    bridge.processed(spark, SF).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("name", ["f6_validate", "p4_map_processed", "q6_anomalies", "a2_device_risk", "q8_contract_errors", "q13_checks", "a19_step_share"])
def test_no_python_in_the_plan(spark, name):
    text = plan(registry.REGISTRY[name](spark, SF))
    assert "Python" not in text and "Arrow" not in text


def test_message_is_parsed_once_even_under_filters(spark):
    text = plan(bridge.staged(spark, SF).filter("is_attack AND protocol = 'TCP' AND packet_size > 5"))
    assert text.count("from_json(StructField(event_timestamp") + text.count("from_json(ArrayType") <= 1
    filters = [line for line in text.splitlines() if " Filter " in line and ("from_json" in line or "try_parse_json" in line)]
    assert not filters


def test_mart_reads_only_its_columns_and_shuffles_once(stored):
    text = plan(marts.protocol_metrics(staging.stage_processed(stored)))
    assert "raw_payload" not in text and "source_ip" not in text
    assert text.count("Exchange hashpartitioning") == 1 and "partial_count" in text


def test_attack_summary_aggregates_before_each_shuffle(stored):
    text = plan(marts.attack_summary(staging.stage_processed(stored)))
    assert text.count("Exchange hashpartitioning") == 2 and "partial_" in text


def test_rules_scan_once_without_a_shuffle(stored):
    text = plan(anomalies.detect(stored))
    assert text.count("FileScan") == 1 and "Exchange" not in text and "Union" not in text


def test_declared_checks_share_one_scan(stored):
    staged = staging.stage_processed(stored)
    assert plan(data_tests.not_null(staged, "m", data_tests.STAGED_PROCESSED)).count("FileScan") == 1
    assert plan(data_tests.run_model(staged, "m", data_tests.STAGED_PROCESSED)).count("FileScan") == 2


def test_top_n_is_not_a_global_sort(stored):
    risk = marts.device_risk(staging.stage_processed(stored))
    text = plan(explore.top(risk, explore.device_order(), 10))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


@pytest.mark.parametrize("name", ["q6_anomalies", "a2_device_risk", "a21_bottleneck", "w1_keep_first", "f13_manifest_validity"])
def test_no_cartesian_product_and_no_window(spark, name):
    text = plan(registry.REGISTRY[name](spark, SF))
    assert "CartesianProduct" not in text and "Window" not in text


def generators(df) -> list[str]:
    return [line for line in plan(df).splitlines() if "Generate inline" in line]


@pytest.mark.parametrize("name", ["loaded", "checked", "faults"])
def test_expressions_are_compiled_before_a_generator(spark, name):
    messages = bridge.messages(spark, SF).selectExpr("row_id AS id", "value", "'iot_processed_logs' AS topic")
    df = {"loaded": lambda: mapping.loaded_rows(messages, bridge.AS_OF), "checked": lambda: validate.check(messages), "faults": lambda: registry.REGISTRY["q8_contract_errors"](spark, SF)}[name]()
    assert generators(df) and not [line for line in generators(df) if "CASE" in line]


def test_document_checks_are_compiled_and_name_the_first_fault(spark):
    whole = '"timestamp":"t","profile":"full","rows":1,"consumer_messages":1,"loader_messages":1,"dry_run":true,"total_elapsed_seconds":1.5'
    step = '{"name":"x","command":["a"],"elapsed_seconds":1}'
    cases = {
        f'{{{whole},"commands":[{step}]}}': None, f'{{{whole},"commands":{{}}}}': "commands must be a list.", f'{{{whole},"commands":null}}': "commands must be a list.",
        f'{{{whole},"commands":[{step},null]}}': "command entry must be a dict.", f'{{{whole},"commands":[{{}}]}}': "command.name must be a str.",
        f'{{{whole},"commands":[{{"name":"x","command":{{}}}}]}}': "command.command must be a list.",
        f'{{{whole},"commands":[{{"name":null,"command":[]}}]}}': "command.name must be a str.", "[1]": "root JSON object must be a dict.", "{}": "timestamp must be a str.",
        '{"timestamp":null}': "timestamp must be a str.", f'{{{whole},"commands":[]}}': "commands must contain at least one step.",
    }
    parsed = benchmark.parse(spark.createDataFrame([(k, k) for k in cases], "file string, content string"))
    assert not [line for line in generators(parsed) if "schema_of_variant" in line or "CASE" in line]
    assert {r["file"]: r["problem"] for r in parsed.collect()} == cases


def test_kept_messages_are_not_parsed_again(spark):
    kept = bridge.kept_checked(spark, SF)
    for made in (bridge.staged, bridge.staged_invalid, bridge.stored_anomalies, bridge.run_audit):
        again, first = made(spark, SF, kept), made(spark, SF)
        assert "from_json" in plan(first) and "from_json" not in plan(again)
        assert again.exceptAll(first).isEmpty() and first.exceptAll(again).isEmpty()


def test_messages_of_a_small_file_are_dealt_over_all_cores(spark):
    dealt, whole = bridge.dealt_messages(spark, SF), bridge.messages(spark, SF)
    assert dealt.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism
    assert dealt.exceptAll(whole).isEmpty() and dealt.count() == whole.count()
