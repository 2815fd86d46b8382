import sys

from newslens.cli import main

sys.exit(main())
