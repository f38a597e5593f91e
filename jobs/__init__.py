"""Runnable jobs: each module has ``run``, which takes a session, and a command line, which makes one."""
