"""Where results are kept: state per period, refreshed where its source changed, and the shared scratch folder."""

from bizmetrics.sinks.scratch import scratch_folder
from bizmetrics.sinks.state import PeriodState, content_mark, file_marks

__all__ = ["PeriodState", "content_mark", "file_marks", "scratch_folder"]
