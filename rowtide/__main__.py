from rowtide.cli import main

raise SystemExit(main())
