"""Small telemetry inputs."""

from datetime import datetime, timedelta, timezone

from pulseframe.schemas import SAMPLES

T0 = datetime(2026, 1, 1, 12, 0, 0, tzinfo=timezone.utc)


def ids(name: str) -> str:
    import uuid

    return str(uuid.uuid5(uuid.NAMESPACE_OID, name))


def sample_rows(n=60, session="s", start=T0, step=1.0, hr=lambda i: 70.0 + i % 5, ibi=lambda i: [800.0 + i, 810.0],
                quality=lambda i: "good", temp=lambda i: 33.0, batch="b", device="d", user="u", sequence=0):
    return [(batch, user, device, session, sequence, i, start + timedelta(seconds=step * i), hr(i), ibi(i), temp(i),
             quality(i), "good", "onBody") for i in range(n)]


def samples(spark, rows):
    return spark.createDataFrame(rows, SAMPLES)
