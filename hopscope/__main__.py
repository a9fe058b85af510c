from hopscope.cli import main

main()
