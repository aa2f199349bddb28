"""A stand-in for a DB-API module: a connection appends what it commits to a journal of files."""

import datetime
import decimal
import json
import os
import time
import uuid

paramstyle = "qmark"


def connect(folder, fail_on=None):
    return Connection(folder, fail_on)


def plain(value):
    if isinstance(value, decimal.Decimal):
        return str(value)
    return value.isoformat(sep=" ") if isinstance(value, datetime.datetime) else value


class Connection:
    def __init__(self, folder, fail_on):
        self.folder, self.fail_on, self.done = folder, fail_on, []

    def cursor(self):
        return self

    def execute(self, sql, values=()):
        values = [plain(v) for v in values]
        if self.fail_on is not None and sql.startswith("INSERT") and self.fail_on in values:
            raise RuntimeError(f"refused: {self.fail_on}")
        self.done.append([sql, values])

    def commit(self):
        name = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
        with open(os.path.join(self.folder, name), "w") as file:
            json.dump(self.done, file)
        self.done = []

    def rollback(self):
        self.done = []

    def close(self):
        pass


def statements(folder):
    for name in sorted(os.listdir(folder)):
        with open(os.path.join(folder, name)) as file:
            yield from json.load(file)
