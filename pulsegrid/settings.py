"""Job settings read from the environment; passwords have no default and are never written to code."""

import os
from dataclasses import dataclass, field


# Names of the environment and of the connector's options.
@dataclass(frozen=True)
class JobSettings:
    kafka_servers: str = "broker:9092"
    topic: str = "vitals"
    model_path: str = "models/risk"
    index: str = "vitalparameters"
    index_host: str | None = None
    index_port: str = "9243"
    index_user: str = "elastic"
    index_password: str | None = field(default=None, repr=False)
    fail_on_data_loss: bool = True
    starting_offsets: str = "earliest"
    case_ids: tuple[int, ...] = ()

    @classmethod
    def from_env(cls, env=os.environ):
        ids = env.get("PATIENT_IDS") or env.get("PATIENT_ID") or ""
        return cls(
            kafka_servers=env.get("KAFKA_SERVER", cls.kafka_servers),
            topic=env.get("KAFKA_TOPIC", cls.topic),
            model_path=env.get("MODEL_PATH", cls.model_path),
            index=env.get("ELASTIC_INDEX", cls.index),
            index_host=env.get("ELASTIC_HOST"),
            index_port=env.get("ELASTIC_PORT", cls.index_port),
            index_user=env.get("ELASTIC_USER", cls.index_user),
            index_password=env.get("ELASTIC_PASSWORD"),
            fail_on_data_loss=env.get("FAIL_ON_DATA_LOSS", "true").lower() != "false",
            starting_offsets=env.get("STARTING_OFFSETS", cls.starting_offsets),
            case_ids=tuple(int(i) for i in ids.split(",") if i.strip()),
        )

    def index_options(self):
        """Options of the search-index sink; unset values are left out."""
        options = {
            "es.resource": self.index,
            "es.nodes": self.index_host,
            "es.port": self.index_port,
            "es.nodes.wan.only": "true",
            "es.net.ssl": "true",
            "es.net.http.auth.user": self.index_user,
            "es.net.http.auth.pass": self.index_password,
            "es.mapping.date.rich": "true",
        }
        return {k: v for k, v in options.items() if v is not None}
