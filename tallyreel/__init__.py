"""tallyreel: viewership and subscription analytics as Spark jobs."""

from tallyreel.config import EngineConfig, standard_config

__all__ = ["EngineConfig", "standard_config"]
