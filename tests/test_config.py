import pytest

from tidemark.streaming.config import StreamConfig

MODE = "STREAMING_TEST_MODE"
SAFE = {"MYSQL_JDBC_URL": "jdbc:h2:mem:stats_test", "MYSQL_TABLE": "realtime_stats_test"}


def load(**env):
    return StreamConfig.from_environment(env)


def test_defaults():
    assert load() == StreamConfig(
        kafka_topic="ratings",
        kafka_servers="localhost:9092",
        checkpoint_path=None,
        output_path="output/realtime_stats",
        jdbc_url="jdbc:mysql://localhost:3306/bigdata_ana",
        jdbc_user="root",
        jdbc_password="",
        jdbc_table="realtime_stats",
        jdbc_enabled=True,
    )


def test_values_are_trimmed_but_the_password_is_not():
    config = load(KAFKA_TOPIC=" t ", MYSQL_PASSWORD=" p ", MYSQL_USER="  ", STREAMING_CHECKPOINT_PATH=" /c ")
    assert (config.kafka_topic, config.jdbc_password, config.jdbc_user) == ("t", " p ", "root")
    assert config.checkpoint_path == "/c"


@pytest.mark.parametrize("env", [
    {},
    {"MYSQL_JDBC_URL": "jdbc:mysql://localhost:3306/bigdata_ana", "MYSQL_TABLE": "realtime_stats"},
    {"MYSQL_JDBC_URL": SAFE["MYSQL_JDBC_URL"]},
    {"MYSQL_TABLE": SAFE["MYSQL_TABLE"]},
    {**SAFE, "MYSQL_TABLE": " realtime_stats "},
])
def test_test_mode_refuses_production(env):
    with pytest.raises(ValueError, match="production MySQL"):
        load(**{MODE: "true", "MYSQL_ENABLED": "true"}, **env)
    with pytest.raises(ValueError, match="production MySQL"):
        load(**{MODE: "1"}, **env)  # the export is on by default


def test_test_mode_allows_an_isolated_target():
    config = load(**{MODE: "true", "MYSQL_ENABLED": "true"}, **SAFE)
    assert config.jdbc_enabled and config.jdbc_table == "realtime_stats_test"


def test_test_mode_allows_production_names_when_the_export_is_off():
    assert not load(**{MODE: "true", "MYSQL_ENABLED": "no"}).jdbc_enabled


@pytest.mark.parametrize("text,value", [
    ("true", True), ("TRUE", True), ("1", True), (" Yes ", True),
    ("false", False), ("0", False), ("NO", False),
])
def test_flags(text, value):
    assert load(MYSQL_ENABLED=text).jdbc_enabled is value


@pytest.mark.parametrize("text", ["", " ", "maybe", "on", "2"])
def test_other_flags_are_errors(text):
    with pytest.raises(ValueError, match="MYSQL_ENABLED"):
        load(MYSQL_ENABLED=text)
    with pytest.raises(ValueError, match=MODE):
        load(**{MODE: text})


def test_the_name_of_the_test_mode_can_be_set():
    with pytest.raises(ValueError, match="production MySQL"):
        StreamConfig.from_environment({"MY_TEST_MODE": "yes"}, test_mode_name="MY_TEST_MODE")
