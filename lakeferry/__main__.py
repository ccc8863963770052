from lakeferry.cli import main

main()
