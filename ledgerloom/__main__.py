from ledgerloom.jobs import main

main()
