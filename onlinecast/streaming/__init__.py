"""Windows, inference and training on unbounded readings."""

from onlinecast.streaming.inference import inference_job, inference_jobs
from onlinecast.streaming.summary import read_summary, summary_job
from onlinecast.streaming.training import continual_job, incremental_job, scheduled_continual_job
from onlinecast.streaming.windows import lookback_windows_stream, training_windows_stream, windows_job

__all__ = [
    "continual_job",
    "incremental_job",
    "inference_job",
    "inference_jobs",
    "lookback_windows_stream",
    "read_summary",
    "scheduled_continual_job",
    "summary_job",
    "training_windows_stream",
    "windows_job",
]
