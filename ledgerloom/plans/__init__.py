"""The batch jobs. ``*_frames`` build lazy frames, ``run_*`` write tables."""
