import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from linkwell.operators import blocking, normalize  # noqa: E402
from linkwell.schema import ENTITY  # noqa: E402
from linkwell.testing import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "4g")
    session.conf.set("spark.sql.shuffle.partitions", "2")
    yield session


def _entities(spark, rows):
    return spark.createDataFrame(rows, ENTITY)


@pytest.fixture(scope="session")
def sample(spark):
    """Three small raw tables with one true match per S1 record."""
    s1 = _entities(spark, [
        ("S1-1", "Acme Corp", "123 Main St", "US"),
        ("S1-2", "Globex Inc", "456 Elm St", "US"),
        ("S1-3", "Initech", "789 Oak Ave", "US"),
    ])
    s2 = _entities(spark, [
        ("S2-1", "Acme Corporation", "123 Main Street", "US"),
        ("S2-2", "Umbrella Corp", "999 Zombie Ln", "US"),
    ])
    s3 = _entities(spark, [
        ("S3-1", "Globex", "456 Elm Street", "US"),
        ("S3-2", "Initech LLC", "789 Oak Avenue", "US"),
    ])
    return s1, s2, s3


@pytest.fixture(scope="session")
def prepared(sample):
    s1, s2, s3 = (normalize.normalize_entities(t, "unicode") for t in sample)
    return s1, blocking.union_targets(s2, s3)


@pytest.fixture(scope="session")
def random_sides(spark):
    """Normalized tables with heavy names, repeated tokens, empty names and empty countries."""
    import random

    rng = random.Random(7)
    words = ["acme", "acmedia", "acmede", "globe", "globex", "it", "inn", "north", "northern", "x"]

    def rows(source, n):
        out = []
        for i in range(n):
            if rng.random() < 0.35:
                name = "acme north"
            else:
                name = " ".join(rng.choice(words) for _ in range(rng.randint(0, 3)))
            out.append((f"{source}-{i}", name, f"{rng.randint(1, 4)} elm st", rng.choice(["us", "fr", ""]), source))
        return out

    schema = "entity_id string, name_norm string, address_norm string, country_norm string, source string"
    s1 = spark.createDataFrame(rows("S1", 80), schema).cache()
    targets = spark.createDataFrame(rows("S2", 90) + rows("S3", 70), schema).cache()
    return s1, targets
