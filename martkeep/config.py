"""Job settings from a properties file."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path

from martkeep.sources import JdbcOptions, KafkaOptions


def read_properties(path: str) -> dict[str, str]:
    """``key=value`` lines; ``#`` and ``!`` start comments."""
    found = {}
    for line in Path(path).read_text(encoding="utf-8").splitlines():
        line = line.strip()
        if line and line[0] not in "#!" and "=" in line:
            key, value = line.split("=", 1)
            found[key.strip()] = value.strip()
    return found


#: Choices of the job that the file can make, and the values they take.
CHOICES = {
    "key.type": ("int", "bigint"),
    "coercion": ("strict", "clamp"),
    "course.run.from": ("mart", "enroll"),
    "compat.fallthrough": ("false", "true"),
    "last.only": ("false", "true"),
    "missing": ("leave", "flag"),
    "null.numbers.as.zero": ("false", "true"),
}


def _choices(values: dict[str, str]) -> dict[str, object]:
    found: dict[str, object] = {}
    for name, allowed in CHOICES.items():
        if name in values:
            value = values[name].lower()
            if value not in allowed:
                raise ValueError(f"{name} must be one of {allowed}")
            found[name.replace(".", "_")] = value == "true" if "true" in allowed else value
    return found


@dataclass(frozen=True)
class JobConfig:
    """Everything the streaming job needs to know about its surroundings.

    Keys of the file: ``kafka.bootstrap.servers``, ``kafka.topics`` (comma-separated) or
    ``kafka.partitions`` (``topic:0,topic:1``), ``kafka.group``; and, with a prefix that
    defaults to ``jdbc``, ``url``, ``username``, ``password`` and ``driver``. The two
    databases and the mart tables may be named by ``source.database``, ``mart.database``,
    ``mart.progress`` and ``mart.enroll``. ``kafka.max.offsets`` bounds a batch, which
    matters when the start time lies far back, and ``kafka.min.partitions`` splits it finer.
    The choices of the job have the names of :class:`~martkeep.streaming.UpkeepOptions` with
    dots: ``key.type``, ``coercion``, ``compat.fallthrough``, ``course.run.from``,
    ``last.only``, ``missing``, ``null.numbers.as.zero``; the broadcast and pushdown limits are
    ``pushdown.keys`` and ``broadcast.keys``.
    """

    kafka: KafkaOptions
    source: JdbcOptions
    mart: JdbcOptions
    progress_table: str
    enroll_table: str
    checkpoint: str
    every: str | None
    choices: dict[str, object] = field(default_factory=dict)
    limits: dict[str, int] = field(default_factory=dict)

    @classmethod
    def from_properties(
        cls, path: str, start_time: str | None = None, jdbc_prefix: str = "jdbc"
    ) -> JobConfig:
        values = read_properties(path)

        def whole(name: str) -> int | None:
            return int(values[name]) if name in values else None

        topics = tuple(t.strip() for t in values.get("kafka.topics", "").split(",") if t.strip())
        partitions: dict[str, list[int]] = {}
        for item in filter(None, values.get("kafka.partitions", "").split(",")):
            topic, number = item.strip().rsplit(":", 1)
            partitions.setdefault(topic, []).append(int(number))
        kafka = KafkaOptions(
            values["kafka.bootstrap.servers"],
            topics=() if partitions else topics,
            partitions=partitions,
            group=values.get("kafka.group"),
            start_time=start_time,
            max_offsets_per_trigger=whole("kafka.max.offsets"),
            min_partitions=whole("kafka.min.partitions"),
        )

        def database(name: str | None) -> JdbcOptions:
            url = values[f"{jdbc_prefix}.url"].rstrip("/")
            options = {}
            if f"{jdbc_prefix}.driver" in values:
                options["driver"] = values[f"{jdbc_prefix}.driver"]
            return JdbcOptions(
                f"{url}/{name}" if name else url,
                values.get(f"{jdbc_prefix}.username", ""),
                values.get(f"{jdbc_prefix}.password", ""),
                **options,
            )

        return cls(
            kafka=kafka,
            source=database(values.get("source.database")),
            mart=database(values.get("mart.database")),
            progress_table=values.get("mart.progress", "TBL_LEARNING_SUBJECT_PROGRESS_RATIO"),
            enroll_table=values.get("mart.enroll", "TBL_ENROLL_MART"),
            checkpoint=values["checkpoint"],
            every=values.get("trigger"),
            choices=_choices(values),
            limits={
                name.replace(".", "_"): int(values[name])
                for name in ("pushdown.keys", "broadcast.keys")
                if name in values
            },
        )
