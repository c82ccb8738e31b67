import re
from pathlib import Path

import wakeline
from wakeline.schema import CLUSTER_SCHEMA, FLEET_STATE_SCHEMA, TABLE_KEYS

TEXT = (Path(wakeline.__file__).parent / "sql" / "tables.sql").read_text()


def tables() -> dict[str, str]:
    return dict(re.findall(r"CREATE TABLE IF NOT EXISTS (\w+) \((.*?)\n\);", TEXT, re.S))


def columns(body: str) -> list[str]:
    return [line.split()[0] for line in body.strip().splitlines()
            if not line.strip().startswith("UNIQUE")]


def test_upserted_tables_have_the_key_the_statements_name():
    found = tables()
    assert set(found) == set(TABLE_KEYS)
    for name, key in TABLE_KEYS.items():
        body = found[name]
        assert set(key) <= set(columns(body))
        if name == "vessel_behavior_clusters":
            continue  # replaced by day, not upserted
        assert f"UNIQUE ({', '.join(key)})" in body or f"{key[0]} BIGINT PRIMARY KEY" in body


def test_columns_are_those_of_the_stored_tables():
    assert columns(tables()["active_fleet_state"]) == FLEET_STATE_SCHEMA.fieldNames()
    assert set(columns(tables()["vessel_behavior_clusters"])) == set(CLUSTER_SCHEMA.fieldNames())
