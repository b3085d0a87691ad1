"""Message publishing (K8).

Messages are one ``value`` string per row. Kafka gets the UTF-8 bytes (F10) via
Spark's batch Kafka sink (needs the spark-sql-kafka package on the classpath);
any file format (``text`` by default) appends one line per message to a folder.
Either way the DataFrame is written by executors; nothing is collected.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from tablesync.functions.message import utf8_payload


@dataclass
class MessageSink:
    format: str = "text"
    path: str | None = None
    topic: str | None = None
    options: dict[str, str] = field(default_factory=dict)

    def publish(self, messages: DataFrame) -> None:
        if self.format == "kafka":
            if not self.topic:
                raise ValueError("a kafka sink needs a topic")
            (
                messages.select(utf8_payload("value").alias("value"))
                .write.format("kafka")
                .option("topic", self.topic)
                .options(**self.options)
                .save()
            )
            return
        if not self.path:
            raise ValueError(f"a {self.format} sink needs a path")
        messages.select("value").write.mode("append").format(self.format).options(**self.options).save(self.path)
