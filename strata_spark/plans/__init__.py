from .run import TABULATED, draw, run_job, sample_job, tabulate_job

__all__ = ["TABULATED", "draw", "run_job", "sample_job", "tabulate_job"]
