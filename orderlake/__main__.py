import sys

from orderlake.jobs import main

sys.exit(main())
