"""``python -m tablesync batch|notify|relay|sizes`` (see ``tablesync.plans.jobs``)."""

import sys

from tablesync.plans.jobs import main

sys.exit(main(sys.argv[1:]))
