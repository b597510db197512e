"""Feature stages, learners, calibration, comparison and the four training jobs."""
