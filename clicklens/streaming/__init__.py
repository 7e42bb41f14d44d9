from clicklens.streaming.counters import AreaTopAds, CityCounts
from clicklens.streaming.guard import ClickGuard
from clicklens.streaming.jobs import AdJobs
from clicklens.streaming.running import StateOptions
from clicklens.streaming.stateful import StatefulGuard
from clicklens.streaming.supervisor import JobFailed, Progress, Supervisor

__all__ = [
    "AdJobs", "AreaTopAds", "CityCounts", "ClickGuard", "JobFailed", "Progress", "StateOptions",
    "StatefulGuard", "Supervisor",
]
