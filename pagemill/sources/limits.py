"""A time limit for work on one item, kept by a process of its own.

A parser that hangs, also in native code, or that takes its process down costs one item and no more.
"""

from __future__ import annotations

import contextlib
import ctypes
import multiprocessing
import signal
from collections.abc import Callable
from multiprocessing.connection import Connection
from typing import Any

# Fixed value: the option that ties a process to the end of its parent (Linux).
PR_SET_PDEATHSIG = 1


class ItemFailed(Exception):
    """The item took too long, or took its process down."""


def _serve(work: Callable[..., Any], pipe: Connection) -> None:
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).prctl(PR_SET_PDEATHSIG, signal.SIGKILL)
    while True:
        try:
            arguments = pipe.recv()
        except EOFError:
            return
        pipe.send(work(*arguments))


class LimitedWorker:
    """Calls ``work`` in a forked process that is replaced when a call takes more than ``seconds``."""

    def __init__(self, work: Callable[..., Any], seconds: float):
        self.work, self.seconds = work, seconds
        self.process: multiprocessing.process.BaseProcess | None = None

    def __enter__(self) -> LimitedWorker:
        return self

    def __exit__(self, *_: object) -> None:
        self._stop()

    def _start(self) -> None:
        context = multiprocessing.get_context("fork")
        self.pipe, other = context.Pipe()
        self.process = context.Process(target=_serve, args=(self.work, other), daemon=True)
        self.process.start()
        other.close()

    def _stop(self) -> None:
        if self.process is not None:
            self.process.kill()
            self.process.join()
            self.pipe.close()
            self.process = None

    def __call__(self, *arguments: Any) -> Any:
        if self.process is None:
            self._start()
        try:
            self.pipe.send(arguments)
            if not self.pipe.poll(self.seconds):
                self._stop()
                raise ItemFailed(f"took more than {self.seconds:g} s")
            return self.pipe.recv()
        except (EOFError, BrokenPipeError, ConnectionResetError):
            self._stop()
            raise ItemFailed("the parser's process ended") from None
