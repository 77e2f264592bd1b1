import json

import pytest

from martkeep.sources import KafkaOptions


def test_topic_list(spark):
    options = KafkaOptions("a:9092,b:9092", topics=("t1", "t2"), group="g").reader_options(spark)
    assert options == {
        "kafka.bootstrap.servers": "a:9092,b:9092",
        "subscribe": "t1,t2",
        "kafka.group.id": "g",
        "startingOffsets": "latest",
    }


def test_assigned_partitions(spark):
    options = KafkaOptions("a:9092", partitions={"t": (0, 2)}, max_offsets_per_trigger=5, min_partitions=9)
    found = options.reader_options(spark)
    assert json.loads(found["assign"]) == {"t": [0, 2]} and "subscribe" not in found
    assert (found["maxOffsetsPerTrigger"], found["minPartitions"]) == ("5", "9")


def test_start_time_replaces_the_offsets(spark):
    options = KafkaOptions("a:9092", topics=("t",), start_time="20220928133000").reader_options(spark)
    assert options["startingTimestamp"] == "1664371800000"
    assert "startingOffsets" not in options


def test_either_topics_or_partitions(spark):
    for options in (KafkaOptions("a"), KafkaOptions("a", topics=("t",), partitions={"t": [0]})):
        with pytest.raises(ValueError):
            options.reader_options(spark)
